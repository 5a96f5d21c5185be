"""Header blocks against brute force: cosines over all blocks, whatever the scan left out."""

import math
import random
import re
from collections import Counter

import pytest

from questlake.llm.license_scan import TEMPLATES, TERM, THRESHOLD, _reach, blocks, scan_licenses
from questlake.llm.notices import notices

FORMS = [(form, text) for form, text in notices() if len(text) < 3000]


def _terms(text):
    return Counter(re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def _texts(n=120):
    """Wrapped notices with a growing share of their words replaced, and prose that speaks of licenses."""
    rnd, out = random.Random(3), []
    for at in range(n):
        words = rnd.choice(FORMS)[1].split()
        share = at / n
        words = [rnd.choice(["alpha", "Beta", "license", "the", "v2.0", f"w{rnd.randrange(40)}"]) if rnd.random() < share else w for w in words]
        mark = rnd.choice(["# ", "// ", " * ", "", "-- "])
        lines = [mark + " ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
        out.append("\n".join(["intro words here", "", *lines, "", "x = 1 -- done", "harem rem a--b"]))
    return [*out, *out[:9], "", "one line of a license", None]


@pytest.fixture(scope="module")
def exact():
    """Best (score, license) of each text's blocks, by cosines over the blocks of all texts."""
    texts = _texts()
    found = [blocks(t) if t else [] for t in texts]
    n, df = sum(map(len, found)), Counter()
    for of in found:
        for block in of:
            df.update(set(_terms(block)))
    vector = lambda text: {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in _terms(text).items()}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    sides = [(form, vector(text)) for form, text in sorted(notices())]
    cosines = {}
    for block in {b for of in found for b in of}:
        own = vector(block)
        if own:
            cosines[block] = [(round(sum(w * side.get(t, 0.0) for t, w in own.items()) / norm(own) / norm(side), 9), form) for form, side in sides]
    return texts, found, n, df, cosines


def test_scores_are_those_of_all_blocks(spark, exact):
    texts, found, _, _, cosines = exact
    files = spark.createDataFrame([(i, f"d{i}/f.c", t) for i, t in enumerate(texts)], "doc_id long, path string, text string").repartition(4)
    templates = spark.createDataFrame(TEMPLATES, "license string, template string").where("license <> 'none'")
    got = {r.file_id: r for r in scan_licenses(files, templates).collect()}
    above = 0
    for i, of in enumerate(found):
        scores = [c for block in of for c in cosines.get(block, [])]
        best = max((s for s, _ in scores), default=0.0)
        if best >= THRESHOLD:
            above += 1
            assert got[i].score is not None and got[i].score >= best - 2e-9, i
    assert 20 < above < len(texts) - 10


def test_no_cosine_exceeds_the_bound(exact):
    _, _, n, df, cosines = exact
    reach = _reach(sorted(notices()), df, n, damped=True)
    dropped = 0
    for block, scores in cosines.items():
        bound = reach(block)
        assert bound >= max(s for s, _ in scores) - 1e-8
        dropped += bound < THRESHOLD
    assert dropped > 5


def test_only_marks_at_the_start_of_a_line_are_taken_off():
    assert blocks("# the harem\n# a--b rem c\n") == ["the harem\na--b rem c"]
    assert blocks("/* one */\r\n * two\r\nx = 1") == ["one\ntwo"]
    assert blocks("no license on one line") == blocks("") == blocks("a\nb\n") == []


def test_columns_that_clash_and_a_very_long_text(spark):
    long_text = "# word\n" * 200_000 + "# Released under the MIT License.\n"
    rows = [(1, "a/x.c", long_text, "r", 0.5, "l", "t"), (2, "a/y.c", None, None, None, None, None)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, row string, score double, license string, term string")
    got = {r.file_id: r.own for r in scan_licenses(files, spark.createDataFrame(TEMPLATES, "license string, template string")).collect()}
    assert got == {1: "MIT", 2: None}
