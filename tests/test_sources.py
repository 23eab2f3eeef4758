import os
import time

import pytest

from cellscope.schemas import SIGNAL, USER_INFO
from cellscope.sources import delimited
from cellscope.sources.dimensions import cell_dimension, user_dimension

LINES = [
    "u1|c1|1.0|2.0|1670468511000",   # good line
    "u2|c2|1.0|2.0|notanumber",      # bad number
    "u3",                            # short line
    "u4|c4|1.0|2.0|1|extra",         # long line
    "|c5|1.0|2.0|1670468511000",     # empty key
    "",                              # empty line
]


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


def test_lenient_signals_keep_two_field_lines(spark, workdir):
    _write(workdir, "a.txt", LINES)
    got = delimited.parse_signals_lenient(delimited.read_lines(spark, workdir)).collect()
    assert sorted((r.imsi, r.laccell) for r in got) == [
        ("", "c5"), ("u1", "c1"), ("u2", "c2"), ("u4", "c4")]


def test_full_parse_lenient_and_rejects(spark, workdir):
    _write(workdir, "a.txt", LINES)
    lines = delimited.read_lines(spark, workdir)
    good = delimited.parse_signals_full(lines).collect()
    assert sorted(r.imsi for r in good) == ["", "u1"]
    bad = sorted(r.line for r in delimited.rejects(lines, delimited.signal_is_valid()).collect())
    assert bad == sorted(["u2|c2|1.0|2.0|notanumber", "u3", "u4|c4|1.0|2.0|1|extra", ""])


def test_strict_parse_fails_on_malformed(spark, workdir):
    _write(workdir, "a.txt", LINES[:2])
    strict = delimited.read_strict(spark, workdir, SIGNAL)
    lines = delimited.parse_signals_full(delimited.read_lines(spark, workdir), strict=True)
    for df in (strict, lines):
        for action in (lambda: df.collect(), lambda: df.select("imsi").collect(), lambda: df.count()):
            with pytest.raises(Exception, match="malformed line"):
                action()


def test_every_line_is_parsed_or_rejected(spark, workdir):
    _write(workdir, "a.txt", LINES + ["u|c|||1", "u|c|1|2|", "u|1|", "u|1|-5", "u|1|20|x", "u|c", "|", "||||"])
    lines = delimited.read_lines(spark, workdir)
    for parse, valid in ((delimited.parse_signals_lenient, delimited.signal_pair_is_valid()),
                         (delimited.parse_signals_full, delimited.signal_is_valid()),
                         (delimited.parse_users_lenient, delimited.user_is_valid()),
                         (delimited.parse_region_cell_lenient, delimited.cell_is_valid())):
        assert parse(lines).count() + delimited.rejects(lines, valid).count() == lines.count()


def test_typed_scan_prunes_columns(spark, workdir):
    _write(workdir, "a.txt", LINES[:1])
    df = delimited.read_signals(spark, workdir).select("imsi")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<imsi:string>" in plan


def test_users_lenient_drops_bad_and_negative_age(spark, workdir):
    _write(workdir, "u.txt", ["a|1|18", "b|0|x", "c|1|-3", "d|0", "e|1|40"])
    got = delimited.parse_users_lenient(delimited.read_lines(spark, workdir)).collect()
    assert sorted(r.imsi for r in got) == ["a", "e"]


def test_dimension_last_write_wins(spark, workdir):
    _write(workdir, "1.txt", ["a|1|18", "b|0|30", "a|1|19"])   # same key twice: later line
    time.sleep(1.1)
    _write(workdir, "2.txt", ["b|1|31"])                       # later file
    got = {r.imsi: (r.gender, r.age) for r in user_dimension(spark, workdir).collect()}
    assert got == {"a": ("1", 19), "b": ("1", 31)}


def test_dimension_ttl_drops_old_files(spark, workdir):
    old = _write(workdir, "old.txt", ["r9|c9"])
    _write(workdir, "new.txt", ["r1|c1"])
    past = time.time() - 3 * 86400
    os.utime(old, (past, past))
    got = {r.laccell: r.region_id for r in cell_dimension(spark, workdir, 86400).collect()}
    assert got == {"c1": "r1"}


def test_user_info_typed_scan(spark, workdir):
    _write(workdir, "u.txt", ["a|1|18"])
    r = delimited.read_user_info(spark, workdir).first()
    assert (r.imsi, r.gender, r.age) == ("a", "1", 18)
    assert delimited.read_user_info(spark, workdir).schema == USER_INFO
