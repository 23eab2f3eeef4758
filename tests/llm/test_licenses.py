import random

from cellscope.llm import licenses as lc
from tests.llm import cases


def brute(text):
    """Every passage against every template, without bounds."""
    best = {}
    for _, _, passage in lc.passages(text):
        a = lc.bigrams(passage)
        top = None
        for name in sorted(lc.TEMPLATES):
            for t in lc.TEMPLATES[name]:
                b = lc.bigrams(t)
                dice = 2 * len(a & b) / (len(a) + len(b)) if a or b else 0
                if dice >= lc.LEAST and (top is None or dice > top[0]):
                    top = dice, name
        if top and top[0] > best.get(top[1], 0):
            best[top[1]] = top[0]
    return best


def noisy(rng, text):
    words = text.split()
    for _ in range(rng.randrange(len(words) // 4 + 1)):
        words[rng.randrange(len(words))] = rng.choice(["the", "thing", "of", "License"])
    return " ".join(words)


def test_scan_equals_comparison_without_bounds():
    rng = random.Random(6)
    texts = [t for name in lc.TEMPLATES.values() for t in name]
    sets = lc.Templates(lc.TEMPLATES, lc.LEAST)
    found = 0
    for _ in range(150):
        parts = [cases.prose(rng, rng.randrange(40)), noisy(rng, rng.choice(texts)), cases.prose(rng, 20)]
        rng.shuffle(parts)
        text = rng.choice(["\n", "\n\n", ". "]).join(parts)
        got = {name: dice for name, dice, *_ in lc.scan(text, sets)}
        assert got == brute(text)
        found += len(got)
    assert found > 60


def test_every_template_is_its_own_best_match():
    sets = lc.Templates(lc.TEMPLATES, lc.LEAST)
    for name, texts in lc.TEMPLATES.items():
        for t in texts:
            text = "Some words before it.\n\nCopyright (c) 2020 Somebody\n" + t.upper() + "\n\nand after."
            assert name in {hit[0] for hit in lc.scan(text, sets)}, (name, t)


def test_versions_are_told_apart():
    sets = lc.Templates(lc.TEMPLATES, lc.LEAST)
    for name in ("GPL-2.0", "GPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"):
        for t in lc.TEMPLATES[name]:
            assert [h[0] for h in lc.scan("x y z\n" + t, sets)] == [name]


def laid_out(rng, text):
    """A licence text inside a longer document, its paragraphs and lines kept."""
    return cases.prose(rng, 300) + "\n\n" + text.strip() + "\n\n" + cases.prose(rng, 300)


def test_whole_texts_in_a_longer_document_are_found():
    rng, every = random.Random(3), lc.every_template()
    sets = lc.Templates(every, lc.LEAST)
    for name in lc.WHOLE:
        text = laid_out(rng, every[name][-1])
        got = lc.scan(text, sets)
        assert [h[0] for h in got] == [name] and got[0][1] > 0.95, (name, got)
        # The notice inside a text can fit as well as the whole text.
        assert max(h[1] for h in lc._found(text, sets).values() if h[4] - h[3] > 0.8 * len(every[name][-1])) > 0.95


def test_licenses_named_by_notice():
    sets = lc.Templates(lc.every_template(), lc.LEAST)
    for name, notices in lc.TEMPLATES.items():
        for t in notices:
            assert [h[0] for h in lc.scan("Some words before it.\n\n" + t, sets)] == [name], t


def test_runs_equal_comparison_of_all_runs():
    """Every run of lines or paragraphs against every template, from the definition."""
    rng, every = random.Random(8), lc.every_template()
    few = {name: every[name] for name in ("MIT", "BSD-3-Clause", "ISC")}
    sets, found = lc.Templates(few, lc.LEAST), 0
    for _ in range(12):
        body = rng.choice([t[-1] for t in few.values()])
        words = [w if rng.random() > 0.04 else "thing" for w in body.split(" ")]
        text = cases.prose(rng, 40) + rng.choice(["\n", "\n\n"]) + " ".join(words) + "\n" + cases.prose(rng, 40)
        best = {}
        for cut in (lc._PARAGRAPH, lc._LINE):
            parts = [p for p in cut.split(text)]
            for i in range(len(parts)):
                for j in range(i + 1, len(parts) + 1):
                    a = lc.bigrams("\n".join(parts[i:j]))
                    for name, t in sorted((n, t) for n, ts in few.items() for t in ts):
                        b = lc.bigrams(t)
                        dice = 2 * len(a & b) / (len(a) + len(b))
                        if dice >= lc.LEAST:
                            best[name] = max(best.get(name, 0), dice)
        got = {name: dice for name, dice, *_ in lc.scan(text, sets)}
        assert got == best
        found += len(got)
    assert found > 8


def test_part_of_a_text_and_a_notice_beside_it():
    every = lc.every_template()
    sets = lc.Templates(every, lc.LEAST)
    text = every["BSD-3-Clause"][-1] + "\n\nand for the rest\n\n" + every["BSD-2-Clause"][-1]
    got = {h[0]: h for h in lc.scan(text, sets)}
    assert set(got) == {"BSD-2-Clause", "BSD-3-Clause"}
    assert got["BSD-2-Clause"][3] >= got["BSD-3-Clause"][4]


def test_edges(spark):
    rows = [*cases.edge_texts(), (20, "Released under the MIT License."), (20, "Released under the MIT License."),
            (None, "a b c\nLicensed under CC BY-NC 4.0.\nd e f")]
    got = lc.license_scan(cases.documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.license, r.passage, r.from_char, r.to_char) for r in got) == [
        ("20", "MIT", "text", 0, 31), ("20", "MIT", "text", 0, 31), ("None", "CC-BY-NC-4.0", "line", 6, 34)]
    assert lc.license_scan(cases.empty(spark)).collect() == []
