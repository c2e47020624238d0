import os

from rankforge.operators import chart
from rankforge.sources import csv as src
from rankforge.streaming import chart_stream, current_best_rank, run_best_rank


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_incremental_best_rank_matches_batch(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    _write(os.path.join(inbox, "w1.csv"), "date,rank,song,artist\n2020-01-04,40,a,x\n2020-01-04,7,b,y\n")
    _write(os.path.join(inbox, "w2.csv"), "date,rank,song,artist\n2020-01-11,12,a,x\n2024-01-01,1,b,y\n")
    out = os.path.join(tmpdir_path, "table")
    ckpt = os.path.join(tmpdir_path, "ckpt")

    stream = chart_stream(spark, inbox, max_files_per_trigger=1)
    run_best_rank(stream, out, ckpt, before="2023")
    got = {(r.song, r.artist): r.top_rank for r in current_best_rank(spark, out).collect()}
    assert got == {("a", "x"): 12, ("b", "y"): 7}

    # a new week arrives; the restarted query only reads the new file
    _write(os.path.join(inbox, "w3.csv"), "date,rank,song,artist\n2020-02-01,3,a,x\n2020-02-01,NA,c,z\n")
    run_best_rank(chart_stream(spark, inbox), out, ckpt, before="2023")
    got = {(r.song, r.artist): r.top_rank for r in current_best_rank(spark, out).collect()}
    batch = chart.best_rank(chart.parse_chart(src.read_csv_typed(spark, inbox, schema=src.CHART_RAW)), before="2023")
    assert got == {(r.song, r.artist): r.top_rank for r in batch.collect()}
    assert got[("a", "x")] == 3 and got[("c", "z")] is None
