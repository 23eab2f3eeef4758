import random
import re
from collections import Counter

import pytest

from cellscope.llm import quality_rules as qr
from tests.llm import cases
from tests.llm.test_common import PATTERN


def brute(text):
    t = text or ""
    w = PATTERN.findall(t)
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if PATTERN.search(x)]
    m = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_lines": len(lines),
         "n_upper": len(re.findall("[A-Z]", t)), "n_stop_words": sum(x in set(qr._stop_forms()) for x in w),
         "n_list_lines": sum(x[:2] in ("- ", "* ", "• ") for x in lines),
         "n_cut_lines": sum(x.endswith(("...", "…")) for x in lines)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    ok = all((m[r.metric] * r.per <= m[r.base] * r.bound) if r.kind == "most" else
             (m[r.metric] * r.per >= m[r.base] * r.bound) for r in qr.RULES)
    return tuple(m[k] for k in qr.METRICS) + (failed, not failed and ok)


def texts():
    rng = random.Random(9)
    out = [t for _, t in cases.edge_texts()]
    for _ in range(60):
        words = [rng.choice("a b the of x Y z## | $$ é 日本 q…".split()) for _ in range(rng.randrange(120))]
        out.append("".join(x + rng.choice([" ", "  ", "\n", "\t", "\x1c", "\n- ", "...\n"]) for x in words))
    prose = cases.prose(rng, 80)
    out += [prose, prose + "\n" + prose, "the word " * 60, "THE END OF IT ALL! " * 3 + prose, "| " * 60 + prose]
    return out


@pytest.mark.parametrize("bits", [16, 4, 48])
def test_metrics_and_verdicts_equal_brute_force(spark, monkeypatch, bits):
    """4: most texts have too many windows to pack; 48: upper bits of different hashes are equal."""
    monkeypatch.setattr(qr, "PACKED_BITS", bits)
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in qr.judge(cases.documents(spark, rows)).collect()}
    kept = 0
    for i, t in rows:
        want = brute(t)
        assert tuple(got[i][k] for k in (*qr.METRICS, "base_failed", "kept")) == want, (i, t[:80] if t else t)
        kept += want[-1]
    assert 0 < kept < len(rows)


def test_plan_is_one_projection(spark):
    plan = qr.judge(cases.documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_edges(spark):
    got = qr.judge(cases.documents(spark)).collect()
    assert len(got) == len(cases.edge_texts())
    blank = [r for r in got if not (r.text or "").strip()]
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in blank)
    assert qr.judge(cases.empty(spark)).collect() == []
