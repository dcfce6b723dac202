"""WARC captures, periodic runs and conversation tries against brute force."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from skygalley.llm import periods, registry, trie, warc  # noqa: E402

TABLES = "/root/testdata/sf0.001"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# --- WARC -----------------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string, type string, payload binary, digest string"
BIG, OTHER = "<p>Hé\r\n\r\nWARC/1.1\r\n\r\n" + "x" * 200, "é" * 50
PAGES = [
    (5, "http://a", BIG),
    (2, "http://b\r\nWARC-Type: x", BIG),
    (9, None, BIG),
    (3, "http://c", "x" * 99),
    (4, "http://d", "x" * 99),
    (6, "http://e", None),
    (7, "http://f", ""),
    (8, "http://g", OTHER),
    (1, "http://h", OTHER),
    (11, "http://i", "y" * 150_000),
    (None, "http://j", OTHER),
    (None, None, "lonely " * 30),
    (12, "http://k", "again " * 40),
    (12, "http://k", "again " * 40),
    (13, "http://k", "again " * 40),
]


def archived(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame([(*r, "t", b"p", "d") for r in rows], PAGE)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, **options)
    return path


def captures_of(spark, path):
    found = warc.resolve_revisits(warc.assemble(warc.read_records(spark, path)))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).collect()


def page_of(capture):
    about = capture["metadata"][0]["fields"] or {}
    return int(about["page-id"]) if "page-id" in about else None


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_come_back_as_captures(spark, tmp_path, compression):
    path = archived(spark, tmp_path, PAGES, compression=compression)
    rows = captures_of(spark, path)
    assert len(rows) == len(PAGES)
    got = sorted(
        (
            str(page_of(r)),
            r["response"]["payload_digest"],
            r["response"]["type"],
            page_of(r["origin"]) if r["origin"] else None,
            (r["origin"] or r)["response"]["payload_bytes"],
        )
        for r in rows
    )
    firsts = {}
    for i, _, html in PAGES:
        if i is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(i, firsts.get(html, i))
    wanted = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = firsts.get(html)
        again = first is not None and i != first
        wanted.append(
            (str(i), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None, len(body))
        )
    assert got == sorted(wanted, key=str) or got == sorted(wanted)
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 and r["part"] == 0 for r in rows)
    assert {r["requests"][0]["target_uri"] for r in rows} >= {"http://a", "http://b%0D%0AWARC-Type: x", None}


def test_records_keep_payloads(spark, tmp_path):
    path = archived(spark, tmp_path, PAGES)
    found = warc.read_records(spark, path).where("type = 'response'").collect()
    whole = {r["payload_digest"]: r["payload"].decode() for r in found}
    assert set(whole.values()) == {html or "" for _, _, html in PAGES}
    assert all(hashlib.sha256(t.encode()).hexdigest() == d for d, t in whole.items())


def test_hot_payload_is_dealt_by_row(spark):
    rows = [(i, f"http://{i}", BIG if i % 3 else f"{i} " * 40, None, None, None) for i in range(3000)]
    pages = spark.createDataFrame(rows, PAGE).repartition(4)
    planned = warc.plan_captures(pages, "page_id", "url", "html")
    assert planned.where("first_id = 1").count() == 1999 and planned.count() == 3000
    text = planned._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "row " in text


def test_no_pages_give_no_captures(spark, tmp_path):
    assert captures_of(spark, archived(spark, tmp_path, [])) == []


def record(kind, record_id=None, concurrent=(), body=b"", content_type="application/http; msgtype=response", **more):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind.encode()]
    if record_id:
        lines.append(f"WARC-Record-ID: <{record_id}>".encode())
    lines += [f"warc-concurrent-to: <{c}>".encode() for c in concurrent]
    lines += [f"{k.replace('_', '-')}: {v}".encode() for k, v in more.items()]
    lines += [b"Content-Type: " + content_type.encode(), b"Content-Length: " + str(len(body)).encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + body + b"\r\n\r\n"


def foreign(tmp_path, *files):
    folder = tmp_path / "foreign"
    folder.mkdir()
    for i, content in enumerate(files):
        (folder / f"{i}.warc.gz").write_bytes(content)
    return str(folder)


def test_transactions_of_other_archives(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    about = {"content_type": "application/warc-fields", "body": b"via: x\r\n  y\r\nhops: 2\r\n"}
    records = [
        record("warcinfo", "info", body=b"software: z", content_type="application/warc-fields"),
        record("response", "r1", concurrent=["q1"], body=http + b"one"),
        record("request", "q1", body=b"GET /"),
        record("metadata", "m1", concurrent=["q1"], **about),  # names the request, not the response
        record("response", "r2", body=http + b"two"),
        record("request", "q2", concurrent=["r2"], body=b"GET /"),
        record("metadata", "m2", concurrent=["r2", "r1"], **about),  # belongs to both
        record("metadata", "m3", concurrent=["gone"], **about),
        record("metadata", "a", concurrent=["b"], **about),  # two that only name each other
        record("metadata", "b", concurrent=["a"], **about),
        record("response", None, body=http + b"no id"),
        record("response", "r2", body=http + b"two"),
        record("resource", "s1", body=b"plain", content_type="text/plain"),
    ]
    one_member_each = b"".join(gzip.compress(r) for r in records[:7])
    path = foreign(tmp_path, one_member_each, b"".join(records[7:]), b"")
    rows = warc.assemble(warc.read_records(spark, path)).collect()
    got = {
        r["capture_id"]: (
            r["copies"],
            [q["record_id"] for q in r["requests"]],
            [m["record_id"] for m in r["metadata"]],
            r["response"] and r["response"]["payload_bytes"],
        )
        for r in rows
    }
    assert got["<r1>"] == (1, ["<q1>"], ["<m1>", "<m2>"], 3)
    assert got["<r2>"] == (2, ["<q2>"], ["<m2>"], 3)
    assert got["<gone>"] == (1, [], ["<m3>"], None) and got["<info>"] == (1, [], ["<info>"], None)
    assert got["<s1>"] == (1, [], [], 5)
    assert {k for k, v in got.items() if v[3] is None} == {"<gone>", "<info>", "<a>", "<b>"}
    assert sum(k.startswith("at ") for k in got) == 1
    fields = next(r for r in rows if r["capture_id"] == "<r1>")["metadata"][0]["fields"]
    assert fields == {"via": "x y", "hops": "2"}


def test_records_of_a_hot_capture_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PART_RECORDS", 4)
    records = [record("response", "r", body=b""), record("response", "s", body=b"")]
    records += [record("metadata", f"m{i}", concurrent=["r"], content_type="application/warc-fields") for i in range(30)]
    rows = warc.assemble(warc.read_records(spark, foreign(tmp_path, b"".join(records)))).collect()
    hot = [r for r in rows if r["capture_id"] == "<r>"]
    assert len(hot) > 1 and sum(len(r["metadata"]) for r in hot) == 30
    assert [r["part"] for r in hot if r["response"]] in ([0], [])
    assert sum(r["response"] is not None for r in rows) == 2


@pytest.mark.parametrize("content", [b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"nothing", record("response", "r", body=b"abc")[:-6]])
def test_broken_archives_raise(content):
    with pytest.raises(ValueError):
        list(warc.parse_archive("x", content, True))


# --- periodic runs --------------------------------------------------------------------------------


def runs_by_force(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            part = words[s : s + length]
            if length >= max(least, times * q) and all(part[p:] != part[:-p] for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_force(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_sequences():
    random.seed(3)
    for trial in range(1500):
        n = random.randrange(0, 70)
        words = [random.randrange(random.choice((1, 2, 3))) for _ in range(n)]
        if n > 8 and trial % 2:
            p, s = random.randrange(1, 10), random.randrange(n - 4)
            words = [words[s + (i - s) % p] if s <= i < s + 6 * p and s + p <= n else words[i] for i in range(n)]
        start, length, period = periods.find_runs(np.array([*words, 99], np.int64), 6, 4)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == runs_by_force(words)


def test_wavelet_matrix():
    values = np.random.default_rng(5).permutation(200)
    tree = warc and periods.WaveletMatrix(values)
    for low, high, bound in [(0, 200, 77), (3, 50, 0), (10, 11, 150), (40, 180, 199)]:
        part = np.sort(values[low:high])
        a, b = np.array([low]), np.array([high])
        assert tree.below(a, b, np.array([bound]))[0] == (part < bound).sum()
        assert [tree.kth(a, b, np.array([k]))[0] for k in range(len(part))] == part.tolist()


LONG = " ".join(f"w{i}" for i in range(400))
TEXTS = [
    None,
    "",
    " \t\n",
    "a a a a a a",
    "a a a a a",
    "x a\tb a\nb a b a b y",
    "A a A a A a",
    "one " * 5000,
    f"{LONG} " * 5 + "tail",
    f"{LONG} {LONG} {LONG}",
    "a a a a a a b " * 4,
    "é è é è é è é è",
]


def test_collapse_on_edge_cases(spark):
    rows = [(i, t, 1, "k") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, "k"), (None, TEXTS[3], 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, kept_text string")
    found = periods.collapse_runs(docs, carry=["kept_text", "runs"])
    assert found.columns == ["doc_id", "n_words", "runs", "kept_text", "kept_text", "runs"]
    got = sorted((str(r[0]), r[1], [tuple(x) for x in r[2]], r[3]) for r in found.collect())
    wanted = []
    for i, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = runs_by_force(words)
        wanted.append((str(i), len(words), runs, collapsed_by_force(words, runs)))
    assert got == sorted(wanted)
    assert periods.collapse_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.collapse_runs(docs, times=3)


def test_op12_against_brute_force(spark):
    got = {r["doc_id"]: r.asDict() for r in registry.op12_periodic_runs(spark, TABLES).collect()}
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue  # quadratic by force
        runs = runs_by_force(words)
        planted += bool(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        row = got[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert (row["n_runs"], row["runs_sha256"]) == (len(runs), hashlib.sha256(lines.encode()).hexdigest())
        assert (row["start"], row["length"], row["period"]) == (best or (None, None, None))
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed_by_force(words, runs).encode()).hexdigest()
    assert planted > 5


# --- tries ----------------------------------------------------------------------------------------


def trie_by_force(conversations):
    """{(depth, beginning): values} from {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[k] for k in children[node]]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ids = ",".join(map(str, sorted(ends[node])))
        out[node] = (
            min(members[node]),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(members[node]),
            len(below),
            sum(b[5] for b in below) or 1,
            (len(members[node]) - 1) * words + sum(b[6] for b in below),
            hashlib.sha256(ids.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def random_conversations(seed, n):
    random.seed(seed)
    out = {}
    for c in random.sample(range(-50, 10 * n), n):
        kind = random.random()
        if kind < 0.3:
            out[c] = [("user", "the same first turn"), ("bot", "the same answer")]  # a third are copies
        elif kind < 0.35:
            out[c] = [("user", f"t{i % 3}") for i in range(random.randrange(40))]  # beginnings of one another
        elif kind < 0.4:
            out[c] = []
        else:
            out[c] = [(random.choice("ab"), random.choice(["", "x", "x y", " z\t"])) for _ in range(random.randrange(6))]
    return out


def turns_of(spark, conversations):
    rows = [(c, i, r or None, t or None) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    empty = [(c,) for c, turns in conversations.items() if not turns]
    convs = trie.conversations(rows)
    return convs.unionByName(spark.createDataFrame(empty, "conv_id long"), allowMissingColumns=True)


@pytest.mark.parametrize("seed, n, batch_paths", [(1, 60, 4096), (2, 60, 5), (3, 400, 40)])
def test_trie_of_random_conversations(spark, seed, n, batch_paths):
    found = random_conversations(seed, n)
    nodes = trie.prefix_trie(turns_of(spark, found), batch_paths).drop("last_turn").collect()
    assert sorted((tuple(r) for r in nodes), key=str) == trie_by_force(found)


def test_turns_are_ordered_and_told_apart(spark):
    rows = [
        (1, None, "a", "first", 5),
        (1, 2, "a", "later", 5),
        (1, -1, None, "then", 5),
        (2, 0, "a", "first", 5),
        (2, 0, "a", "first", 5),
        (3, 0, "ab", "c", 5),
        (4, 0, "a", "bc", 5),
        (None, 0, "a", "nobody", 5),
    ]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int")
    nodes = trie.prefix_trie(trie.conversations(rows)).collect()
    wanted = {
        1: [("a", "first"), ("", "then"), ("a", "later")],
        2: [("a", "first"), ("a", "first")],
        3: [("ab", "c")],
        4: [("a", "bc")],
    }
    assert sorted((tuple(r[c] for c in r.asDict() if c != "last_turn") for r in nodes), key=str) == trie_by_force(wanted)
    texts = {bytes(r["last_turn"]): r["text"] for r in trie.turn_texts(rows).collect()}
    assert {texts[bytes(r["last_turn"])] for r in nodes if r["depth"]} == {"first", "then", "later", "c", "bc"}
    assert trie.prefix_trie(trie.conversations(rows.limit(0))).count() == 0


def test_rebuilt_conversations_by_hand(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in (20, 21, 33, 40, 59) for t in range(1 + c % 4)] + [(45, None, "u", "x")]
    rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {r["conv_id"]: [bytes(t["digest"]) for t in r["turns"]] for r in trie.conversations(rows).collect()}
    got = {
        r["conv_id"]: [bytes(t["digest"]) for t in r["turns"]]
        for r in registry.rebuilt_conversations(trie.conversations(rows)).collect()
    }
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        assert got[c] == convs.get(c - c % 20, [])[:h] + own[h:]
