"""The whole pipeline against a plain version of its five stages, on a small table of planted cases."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

import corpus_pipeline  # noqa: E402
from test_llm import brute_repeats, check_packing, lower, words_in  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": [a + b for a in ("the", "with", "house", "thing", "king") for b in ("", "s", "ing", "er", "ly", "ness")],
    "de": [a + b for a in ("der", "schluss", "haus", "ding", "weg") for b in ("", "en", "ung", "lich", "heit", "chen")],
}


def planted():
    """Texts of two languages with copies, near copies, chains of them, repeated passages, repeated and missing ids."""
    rnd = random.Random(11)

    def prose(lang, n):
        return " ".join(f"{rnd.choice(WORDS[lang])}{rnd.randrange(40)}" for _ in range(n))

    def change(text, at):
        w = text.split()
        w[at] = "changed"
        return " ".join(w)

    rows = [(i, prose(rnd.choice(list(WORDS)), rnd.randrange(1, 160))) for i in range(100, 160)]
    base, other, passage = prose("en", 90), prose("de", 120), prose("en", 60)
    rows += [(3, base), (2, base.upper()), (9, base), (9, base)]  # copies, in other case, repeated rows
    rows += [(20, other), (21, change(other, 60)), (22, change(change(other, 60), 20))]  # a chain
    rows += [(21, prose("de", 80)), (20, prose("en", 70))]  # clean texts under the ids of near copies
    rows += [(None, change(other, 100)), (None, prose("en", 50)), (None, prose("de", 45))]
    rows += [(30 + i, f"{prose('en', 30)} {passage} {prose('en', 25)}") for i in range(4)]
    rows += [(40, passage), (41, None), (42, ""), (43, "12 345 ..."), (44, "word"), (45, prose("en", 3000))]
    rnd.shuffle(rows)
    return [(i, t, "de" if t and "schluss" in t else "en", "s", len(t or "")) for i, t in rows]


def order(key):
    return (key is None, key or 0)


def plain_near(rows):
    """Indices of the rows that stay."""
    sets = []
    for _, text in rows:
        w = words_in(lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for i, g in enumerate(group):
        if g not in best or order(rows[i][0]) < order(rows[best[g]][0]):
            best[g] = i
    return [rows[i] for i in best.values()]


def plain_run(rows):
    rows = [(i, t) for i, t, *_ in rows if any(c.isalpha() for c in t or "")]
    last = {}
    for i, t in rows:
        if lower(t) not in last or (i is not None, i or 0) >= (last[lower(t)][0] is not None, last[lower(t)][0] or 0):
            last[lower(t)] = (i, t)
    rows = plain_near(list(last.values()))
    out = Counter()
    for (i, t), (_, n, gone, kept) in zip(sorted(rows, key=repr), cut_in_order(sorted(rows, key=repr))):
        if not gone or gone < n:
            out[(i, kept if gone else t)] += 1
    return out


def cut_in_order(rows):
    """``brute_repeats`` row by row: its result is sorted, so each row is looked up by a number of its own."""
    found = brute_repeats(rows, 20)
    mine = []
    for i, t in rows:
        n = len(words_in(t))
        fits = [x for x in found if x[0] == i and x[1] == n and (x[2] or x[3] == " ".join(words_in(t)))]
        mine.append(fits[0])
        found.remove(fits[0])
    return mine


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    rows = planted()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return rows, str(folder)


def test_near_dedup_judges_rows(spark, run):
    rows, folder = run
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, folder).collect())
    pairs = [(i, t) for i, t, *_ in rows]
    want = plain_near(pairs)
    assert Counter(i for i, _ in got.elements()) == Counter(i for i, _ in want)
    clean = [(i, t) for i, t in pairs if i in (20, 21) and len((t or "").split()) < 100]
    assert len(clean) == 2 and all(got[x] == 1 for x in clean)


def test_run_equals_plain_version(spark, run):
    rows, folder = run
    want = plain_run(rows)
    assert 60 < sum(want.values()) < len(rows) - 8
    cut = spark.createDataFrame([(i, t) for (i, t), n in want.items() for _ in range(n)], "doc_id long, text string")
    sequences = check_packing(corpus_pipeline.run(spark, folder).collect(), cut, 1024)
    assert sequences > 1
