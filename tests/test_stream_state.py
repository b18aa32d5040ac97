"""The keyed state of stream_deltas is one compressed value a lane, and a row comes back from it with every column as it was."""

import pickle

from pyspark.sql import functions as F

from snapmetrics.plans.snapshots import snapshot_deltas
from snapmetrics.streaming import streams as st
from test_stream_lanes import frame
from test_streams import SNAP, State, deliver, rows_of, snap


def test_a_lanes_state_is_much_smaller_than_its_rows():
    state = State()
    rows = frame(*((link, n, n) for link in "abcd" for n in range(300)))
    rows["row"] = [f"{n},{n},{n}{st.SEP}" + st.SEP.join(["https://s1.example.bg/a/123", "t123", "error - k3", "2024-01-01 00:00:00"]) for n in range(len(rows))]
    told = next(st._follow((0,), iter([rows]), state))
    assert len(told) == 1200 and len(state.get[0]) == 1200  # nothing is let go before the watermark moves
    assert told["prev"].dropna().str.len().max() < 20  # of the row before, what the deltas need
    assert len(pickle.dumps(state.get)) * 4 < rows["row"].str.len().sum()


ODD = [f"{st.SEP}{st.ESC}", f"{st.ESC}1{st.ESC}0{st.SEP}1", st.ESC, "", ",", "\n\r\t\"\\", "é\u0085 😀", None]


def test_texts_come_back_as_they_were(spark, tmp_path):
    rows = [(n, x, f"l{n % 2}{x}", x, ODD[n - 1], None if n % 3 else "c", None if n % 2 else -n, 2**60 + n, "2024-01-01 00:00:00", f"2024-01-0{1 + n} 10:00:00")
            for n, x in enumerate(ODD)]
    rows += [(100 + r[0], *r[1:-1], "2024-02-01 00:00:00") for r in rows]
    path = str(tmp_path)
    schema = deliver(spark, rows[:10], path)
    for more in (rows[10:], [snap(500, "l", 1, "n/a")]):
        st.stream_deltas(spark, f"{path}/landing", schema, f"{path}/tables", f"{path}/ckpt", year=2024)
        deliver(spark, more, path)
    st.stream_deltas(spark, f"{path}/landing", schema, f"{path}/tables", f"{path}/ckpt", year=2024)
    stored = st._rows(spark, f"{path}/tables", schema).filter("kind = 'delta' AND NOT told").select(*schema.fieldNames())
    assert rows_of(stored) == sorted(rows, key=str)
    batch = spark.createDataFrame(rows, SNAP)
    assert rows_of(st.current_deltas(spark, f"{path}/tables", schema)) == rows_of(snapshot_deltas(batch, 2024))


def test_times_without_microseconds_and_before_1970(spark):
    schema = spark.createDataFrame([], SNAP).schema
    df = spark.createDataFrame([snap(1, "l", None, "1901-02-03 04:05:06"), snap(2, "l", 7, None)], SNAP)
    visit = st.stamp("visited_timestamp")
    text = df.select(F.split(st._row_text(schema, visit), st.SEP, -1).alias("p"), visit.cast("timestamp_ntz").alias("v"))
    got = text.select(st._numbers(F.col("p")[0], schema).alias("n"), "v").select("n.visited", "v", "n.comments", "n.views").collect()
    assert all(r["visited"] == r["v"] for r in got) and [tuple(r)[2:] for r in got] == [(0, None), (0, 7)]
