import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from cellscope.operators import persona
from cellscope.operators.sinks import latest_snapshot, upsert_snapshot
from cellscope.sources.delimited import write_lines
from cellscope.streaming import jobs
from cellscope.streaming.sources import signal_pair_stream, signal_stream, text_lines

T0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _signal_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for imsi, cell, minute in rows:
            fh.write(f"{imsi}|{cell}|0.0|0.0|{T0 + minute * 60000}\n")


def _dims(spark, workdir):
    users = spark.createDataFrame([("u1", "1", 15), ("u2", "0", 45)],
                                  "imsi string, gender string, age int")
    cells = spark.createDataFrame([("A", "c1"), ("B", "c2")], "region_id string, laccell string")
    return users, cells


def _headcount_query(spark, src, out, chk, users, cells):
    sig = signal_stream(text_lines(spark, src, max_files=1))
    enriched = jobs.enrich_static(sig, users, cells)
    counts = jobs.headcount_stream(jobs.flows_stream(enriched))
    return jobs.start_upsert(counts, out, ["region_id"], ["man"], chk)


def test_flows_state_across_batches_and_restart(spark, workdir):
    users, cells = _dims(spark, workdir)
    src, out, chk = f"{workdir}/src", f"{workdir}/snap", f"{workdir}/chk"
    # User u1 moves A, A, B, A, (unknown cell), B over several files.
    _signal_file(src, "f1.txt", [("u1", "c1", 0), ("u1", "c1", 1)])
    _signal_file(src, "f2.txt", [("u1", "c2", 2)])
    jobs.run_to_end(_headcount_query(spark, src, out, chk, users, cells))
    first = {r.region_id: r.man for r in latest_snapshot(spark, out).collect()}
    assert first == {"A": 0, "B": 1}
    # Restart from the checkpoint with new files: state (u1 in B) survives.
    time.sleep(1.1)
    _signal_file(src, "f3.txt", [("u1", "c1", 3), ("u1", "c9", 4), ("u2", "c1", 4)])
    time.sleep(1.1)
    _signal_file(src, "f4.txt", [("u1", "c2", 5)])
    jobs.run_to_end(_headcount_query(spark, src, out, chk, users, cells))
    final = {r.region_id: (r.man, r.women, r.age_40) for r in latest_snapshot(spark, out).collect()}
    # u1 ends in B; u2 (female, 45) entered A late and stayed.
    assert final == {"A": (0, 1, 1), "B": (1, 0, 0)}


def test_window_stream_equals_batch(spark, workdir):
    users, cells = _dims(spark, workdir)
    src = f"{workdir}/src"
    _signal_file(src, "f1.txt", [("u1", "c1", 0), ("u2", "c1", 0), ("u1", "c2", 1),
                                 ("u2", "c1", 2)])
    sig = signal_stream(text_lines(spark, src))
    counts = jobs.persona_window_stream(jobs.enrich_static(sig, users, cells))
    q = jobs.start_upsert(counts, f"{workdir}/snap", ["region_id", "window_start"],
                          ["window_end"], f"{workdir}/chk")
    jobs.run_to_end(q)
    got = sorted(tuple(r) for r in latest_snapshot(spark, f"{workdir}/snap")
                 .select("region_id", "window_start", *persona.PERSONA_COLUMNS).collect())
    batch_sig = signal_stream(spark.read.text(src))
    want = sorted(tuple(r) for r in persona.persona_window(
        persona.enrich(batch_sig, users, cells))
        .select("region_id", "window_start", *persona.PERSONA_COLUMNS).collect())
    assert got == want


def test_upsert_replay_is_idempotent(spark, workdir):
    base = f"{workdir}/snap"
    b0 = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v long")
    b1 = spark.createDataFrame([("A", 5), ("A", 7)], "k string, v long")
    upsert_snapshot(b0, 0, base, ["k"], ["v"])
    upsert_snapshot(b1, 1, base, ["k"], ["v"])
    upsert_snapshot(b1, 1, base, ["k"], ["v"])   # replayed batch
    got = {r.k: r.v for r in latest_snapshot(spark, base).collect()}
    assert got == {"A": 7, "B": 2}


def test_stage_a_sees_dimension_added_between_batches(spark, workdir):
    src, upath, cpath = f"{workdir}/src", f"{workdir}/users", f"{workdir}/cells"
    out, rej, chk = f"{workdir}/enriched", f"{workdir}/rejects", f"{workdir}/chk"
    write_lines(spark.createDataFrame([("u1", "1", 20)], "imsi string, g string, a int"),
                upath, ["imsi", "g", "a"])
    write_lines(spark.createDataFrame([("A", "c1")], "r string, c string"), cpath, ["r", "c"])
    _signal_file(src, "f1.txt", [("u1", "c1", 0), ("u2", "c1", 0)])
    sig = signal_stream(text_lines(spark, src, max_files=1))
    jobs.run_to_end(jobs.start_enrich_stage(sig, upath, cpath, out, rej, chk))
    # u2's profile arrives in a new file before the next micro-batch.
    write_lines(spark.createDataFrame([("u2", "0", 50)], "imsi string, g string, a int"),
                upath, ["imsi", "g", "a"], mode="append")
    time.sleep(1.1)
    _signal_file(src, "f2.txt", [("u2", "c1", 1)])
    sig = signal_stream(text_lines(spark, src, max_files=1))
    jobs.run_to_end(jobs.start_enrich_stage(sig, upath, cpath, out, rej, chk))
    enriched = spark.read.schema(jobs.ENRICHED).parquet(out)
    got = sorted((r.imsi, r.procedureStartTime - T0) for r in enriched.collect())
    assert got == [("u1", 0), ("u2", 60000)]
    rejects = spark.read.parquet(rej).select("imsi", "reason").collect()
    assert [(r.imsi, r.reason) for r in rejects] == [("u2", "unknown_user")]


def test_processing_time_window_runs(spark, workdir):
    users, cells = _dims(spark, workdir)
    src = f"{workdir}/src"
    _signal_file(src, "f1.txt", [("u1", "c1", 0)])
    sig = signal_stream(text_lines(spark, src))
    counts = jobs.persona_window_stream(jobs.enrich_static(sig, users, cells),
                                        time_mode="processing")
    q = jobs.start_upsert(counts, f"{workdir}/snap", ["region_id"], ["window_start"],
                          f"{workdir}/chk")
    jobs.run_to_end(q)
    row = latest_snapshot(spark, f"{workdir}/snap").first()
    assert (row.region_id, row.man) == ("A", 1)
    assert F is not None


def test_two_stage_headcount_equals_batch(spark, workdir):
    from cellscope.sources.dimensions import DimensionSnapshot
    src, upath, cpath = f"{workdir}/src", f"{workdir}/users", f"{workdir}/cells"
    out, rej = f"{workdir}/enriched", f"{workdir}/rejects"
    write_lines(spark.createDataFrame([("u1", "1", 20), ("u2", "0", 50)],
                                      "imsi string, g string, a int"), upath, ["imsi", "g", "a"])
    write_lines(spark.createDataFrame([("A", "c1"), ("B", "c2")], "r string, c string"), cpath,
                ["r", "c"])
    _signal_file(src, "f1.txt", [("u1", "c1", 0), ("u2", "c1", 0), ("u1", "c2", 1)])
    time.sleep(1.1)
    _signal_file(src, "f2.txt", [("u2", "c2", 2), ("u1", "c1", 3), ("u3", "c1", 3)])
    sig = signal_stream(text_lines(spark, src, max_files=1))
    jobs.run_to_end(jobs.start_enrich_stage(sig, upath, cpath, out, rej, f"{workdir}/chkA"))
    # A replayed, already committed batch is skipped (files untouched).
    before = sorted(spark.read.parquet(f"{out}/batch_id=0").inputFiles())
    users = DimensionSnapshot(spark, upath, "user", "imsi")
    cells = DimensionSnapshot(spark, cpath, "cell", "laccell")
    replay = signal_stream(spark.read.text(f"{src}/f1.txt"))
    jobs.write_enriched_batch(replay, 0, users, cells, out, rej)
    assert sorted(spark.read.parquet(f"{out}/batch_id=0").inputFiles()) == before

    counts = jobs.headcount_stream(jobs.flows_stream(jobs.enriched_stream(spark, out, 1)))
    jobs.run_to_end(jobs.start_upsert(counts, f"{workdir}/snap", ["region_id"], ["man"],
                                      f"{workdir}/chkB"))
    got = sorted(tuple(r) for r in latest_snapshot(spark, f"{workdir}/snap")
                 .select("region_id", *persona.PERSONA_COLUMNS).collect())
    enriched = spark.read.schema(jobs.ENRICHED).parquet(out)
    want = sorted(tuple(r) for r in persona.region_headcount(persona.region_flow(enriched))
                  .select("region_id", *persona.PERSONA_COLUMNS).collect())
    assert got == want
    assert {r[0] for r in got} == {"A", "B"}


def test_old_snapshots_go(spark, workdir):
    base = f"{workdir}/ring"
    for n in range(7):
        batch = spark.createDataFrame([(f"k{n % 2}", n)], "k string, v long")
        upsert_snapshot(batch, n, base, ["k"], ["v"], retain_seconds=0)
    assert sorted(d for d in os.listdir(base) if d.startswith("batch=")) == ["batch=5", "batch=6"]
    got = {r.k: r.v for r in latest_snapshot(spark, base).collect()}
    assert got == {"k0": 6, "k1": 5}


def test_a_lost_snapshot_is_an_error(spark, workdir):
    base = f"{workdir}/lost"
    batch = spark.createDataFrame([("a", 1)], "k string, v long")
    upsert_snapshot(batch, 0, base, ["k"], ["v"])
    with pytest.raises(RuntimeError, match="no finished snapshot of batch 4"):
        upsert_snapshot(batch, 5, base, ["k"], ["v"])
    # A snapshot that was begun but not finished doesn't count.
    batch.write.parquet(f"{base}/batch=9")
    assert latest_snapshot(spark, base).collect() == [("a", 1)]


def test_a_falling_counter_wins_by_batch(spark, workdir):
    base = f"{workdir}/fall"
    for n, v in enumerate((5, 2)):
        upsert_snapshot(spark.createDataFrame([("a", v)], "k string, v long"), n, base, ["k"])
    assert latest_snapshot(spark, base).first().v == 2


def test_late_signals_count(spark, workdir):
    users, cells = _dims(spark, workdir)
    src, base = f"{workdir}/src", f"{workdir}/windows"
    for n, minute in enumerate((600, 5, 1200, 0, 5)):
        _signal_file(src, f"f{n}.txt", [("u1", "c1", minute)])
        time.sleep(0.05)
    enriched = jobs.enrich_static(signal_stream(text_lines(spark, src, max_files=1)), users, cells)
    jobs.run_to_end(jobs.start_window_counts(enriched, base, f"{workdir}/chk"))
    got = jobs.read_window_counts(spark, base).collect()
    assert sorted(r.man for r in got) == [1, 1, 1, 2]


def test_feed_of_pairs_keeps_lines_without_coordinates(spark, workdir):
    users, cells = _dims(spark, workdir)
    os.makedirs(f"{workdir}/src")
    with open(f"{workdir}/src/a.txt", "w") as fh:
        fh.write("u1|c1\nu1|c1|x|y|z\nu1\n")
    enriched = jobs.enrich_static(signal_pair_stream(text_lines(spark, f"{workdir}/src")), users, cells)
    jobs.run_to_end(jobs.start_window_counts(enriched, f"{workdir}/w", f"{workdir}/chk"))
    assert sum(r.man for r in jobs.read_window_counts(spark, f"{workdir}/w").collect()) == 2


def test_malformed_lines_of_the_feed_are_kept(spark, workdir):
    os.makedirs(f"{workdir}/src")
    with open(f"{workdir}/src/a.txt", "w") as fh:
        fh.write("u1|c1|0|0|1\nu1|c1\n")
    lines = text_lines(spark, f"{workdir}/src")
    jobs.run_to_end(jobs.start_rejects(lines, f"{workdir}/bad", f"{workdir}/chk"))
    assert [r.line for r in spark.read.parquet(f"{workdir}/bad").collect()] == ["u1|c1"]
