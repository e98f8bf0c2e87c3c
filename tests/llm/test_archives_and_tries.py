"""Periodic runs, archives and prefix tries against brute force."""

import gzip
import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinfold.llm import queries as Q
from twinfold.llm.periodic_runs import collapsed_texts, find_runs, occurrences, runs_of
from twinfold.llm.prefix_trie import rebuilt, trie_nodes, turn_rows, with_parents
from twinfold.llm.warc import parsed, planned, ranges, read_records, record_bytes, write_archive

EXTRA = ", id long, runs long, word string, digest string, file string"


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


# ---- periodic runs ----------------------------------------------------------


def slow_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q) and not any(q % p == 0 and w[i : i + q] == w[i : i + p] * (q // p) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_collapse(w, runs):
    drop = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(x for k, x in enumerate(w) if k not in drop)


def periodic_texts(n, seed):
    rng = random.Random(seed)
    out = [None, "", "  ", "a " * 400, "\x1c \x85 a", "one", "a a a a a", "a a a a a a", "a b a b a b a b", "x " + "a b c " * 4, "é ü " * 9, "aaaa " * 3 + "\n\t aaaa\x0b aaaa aaaa", " ".join(str(k % 37) for k in range(900)), " ".join("a " * k + f"b{k}" for k in range(1, 40))]
    for _ in range(n):
        w = [rng.choice("abcdefg"[: rng.randrange(1, 6)]) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            unit = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 14))]
            at = rng.randrange(len(w) + 1)
            w[at:at] = (unit * 9)[: rng.randrange(len(unit), 9 * len(unit))]
        out.append(" ".join(w))
    return out


def test_runs_are_all_found():
    texts = periodic_texts(500, 3)
    runs, collapsed = collapsed_texts(pa.array(texts, pa.string()))
    for t, r, c in zip(texts, runs, collapsed.to_pylist()):
        w = words(t)
        assert r == slow_runs(w) and c == slow_collapse(w, r), t
    assert sum(map(len, runs)) > 300 and max(q for r in runs for _, _, q in r) >= 37
    none, empty = collapsed_texts(pa.array([], pa.string()))
    assert none == [] and len(empty) == 0


def test_squared_differences_are_exact():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(1, 3 if size < 8 else 2_000_000, (9, size))
        blocks[4:7] = blocks[3]
        line, hit = blocks.ravel(), occurrences(blocks)
        for k in range(7):
            for d in range(size):
                at = (k + 1) * size + d
                assert hit[d, k] == bool((line[k * size : (k + 1) * size] == line[at : at + size]).all())


def test_hits_by_chance_are_no_runs(monkeypatch):
    """Values far beyond the prime collide in the sums; the words decide."""
    import numpy as np

    from twinfold.llm import periodic_runs as R

    w = np.array([1, 1 + R.PRIME, 1, 1 + R.PRIME, 1, 1 + R.PRIME, 1, 1 + R.PRIME] + [5] * 7, np.int64)
    assert runs_of(w, np.array([15])) == [(0, 8, 7, 1), (0, 0, 8, 2)]


def test_long_periodic_texts():
    """Scales in the thousands, and texts in which every distance of a scale is an occurrence."""
    unit = [str(k * k % 10_007) for k in range(5000)]
    runs, _ = collapsed_texts(pa.array([" ".join(unit * 4 + ["end"]), "x " * 60_000, " ".join(str(k) for k in range(50_000))]))
    assert runs == [[(0, 20_000, 5000)], [(0, 60_000, 1)], []]


def test_op11_rows(spark, tmp_path):
    texts = periodic_texts(150, 9)
    rows = [(k, t, *([0] * 2), "w", "d", "f") for k, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, "a b " * 8, 0, 0, "w", "d", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string" + EXTRA)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in Q.op11_periodic_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    want = Counter()
    for r in rows:
        w, h = words(r[1]), zlib.crc32(("" if r[0] is None else str(r[0])).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        runs = slow_runs(w)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[(r[0], len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(slow_collapse(w, runs)))] += 1
    assert got == want
    assert find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(docs, times=2)


# ---- archives ---------------------------------------------------------------

PAGES = "page_id long, url string, html string" + EXTRA


def page_rows():
    big = ["<p>" + c * 1200 for c in "abc"] + ["é" * 500, "é" * 499]
    rows = [(k, f"http://h{k % 3}/{k}", big[k % 5]) for k in range(40)]
    rows += [(100, "u\r\nWARC-Type: revisit", None), (101, None, ""), (102, "x", "small"), (103, "x", "small"), (104, "u", "WARC/1.1\r\n\r\n" * 300), (105, "u", "\x00\x85é𝔘" * 40_000)]
    rows += [rows[39], rows[39], rows[0], (39, "other", big[4]), (None, "n", big[0]), (None, "n", "only null" * 200), (None, "n", "only null" * 200)]
    return [(*r, 1, 2, "w", "d", "f") for r in rows]


def slow_records(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2] or ""].append(r)
    out = Counter()
    for html, same in groups.items():
        data, ids = html.encode(), [r[0] for r in same]
        top = max((i for i in ids if i is not None), default=None)
        left = ids.copy()
        for _ in ids[:1] if len(data) >= 1000 else ids:
            i = top if len(data) >= 1000 else left[0]
            left.remove(i)
            out[i, len(data), hashlib.sha1(data).hexdigest(), "response", None] += 1
        for i in left:
            out[i, len(data), hashlib.sha1(data).hexdigest(), "revisit", top] += 1
    return out


def record_rows(df):
    return Counter(tuple(r) for r in df.select("id", "payload_bytes", "digest", "record_type", "refers_to").collect())


def test_archive_and_back(spark, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    index = write_archive(pages, f"file://{tmp_path}/warc")
    records = read_records(index)
    assert record_rows(records) == slow_records(rows) == record_rows(index)
    got = {(r["id"], r["record_type"]): r for r in records.collect()}
    assert got[104, "response"]["payload"].decode() == rows[44][2] and got[105, "response"]["payload"].decode() == rows[45][2]
    assert got[100, "response"]["url"] == "u%0D%0AWARC-Type: revisit" and got[101, "response"]["url"] is None and got[0, "revisit"]["payload"] is None
    # Any selection of the index is read alone.
    some = read_records(index.filter("record_type = 'revisit' AND id < 20"))
    assert record_rows(some) == Counter({k: v for k, v in slow_records(rows).items() if k[3] == "revisit" and k[0] is not None and k[0] < 20})
    # Archives are plain WARC: the members of a file, in order, are its records.
    whole = b"".join(gzip.decompress((tmp_path / "warc" / f).read_bytes()) for f in os.listdir(tmp_path / "warc"))
    assert whole.count(b"WARC-Record-ID: ") == len(rows)
    one = [r for r in index.collect() if r["id"] == 105][0]
    data = (tmp_path / "warc" / one["file"].rpartition("/")[2]).read_bytes()[one["offset"] : one["offset"] + one["length"]]
    assert parsed(gzip.decompress(data))["digest"] == one["digest"]
    ids = [x for x in whole.split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
    refers = {x.split(b": ")[1] for x in whole.split(b"\r\n") if x.startswith(b"WARC-Refers-To: ")}
    assert len(set(ids)) == len(rows) and refers <= {x.split(b": ")[1] for x in ids}


def test_archive_of_many_groups(spark):
    """Where groups of equal payloads are too many to broadcast, they are joined by digest."""
    pages = spark.createDataFrame(page_rows(), PAGES)
    plan = lambda n: Counter(tuple(r) for r in planned(pages, "page_id", "url", "html", n).collect())
    assert plan(0) == plan(1000)
    assert write_archive(pages.limit(0)).count() == 0 and read_records(write_archive(pages.limit(0))).count() == 0


def test_damaged_records_are_refused():
    good = record_bytes("1", "u", b"payload", 7, hashlib.sha1(b"payload").hexdigest(), None, False, "s")
    assert parsed(good)["payload"] == b"payload"
    for bad in (good[:-9], good.replace(b"payload", b"paylOad"), b"x" + good):
        with pytest.raises((ValueError, KeyError)):
            parsed(bad)


def test_ranges_coalesce():
    near = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 10_000_000, 5), ("b", 10_000_005, 1)]
    assert list(ranges(near)) == [("a", 0, 25, [(0, 10), (10, 5), (20, 5)]), ("a", 10_000_000, 10_000_005, [(10_000_000, 5)]), ("b", 10_000_005, 10_000_006, [(10_000_005, 1)])]
    assert list(ranges([])) == []
    assert len(list(ranges([("a", k << 20, 1 << 20) for k in range(16)]))) == 4


# ---- prefix tries -----------------------------------------------------------

TALKS = "conv_id long, turn long, role string, text string, id long, place long, box string, depth long, n long"


def talk_rows(n, seed, long=0):
    rng = random.Random(seed)
    common = [(k, "user" if k % 2 else None, f"shared {k}") for k in range(long)]
    out = []
    for c in range(n):
        turns = common[: rng.choice([0, long, long])] + [(100 + k, rng.choice(["user", "bot"]), rng.choice(["hi", "yo", "", None, "é", f"own {c}"])) for k in range(rng.randrange(7))]
        out += [(c * rng.choice([1, 1, 7]), *t, 5, 6, "b", 7, 8) for t in turns]
    if n:
        out += [(3, None, "user", "first", 1, 1, "b", 1, 1), (3, None, "user", "first", 1, 1, "b", 1, 1), (None, 1, "user", "no talk", 1, 1, "b", 1, 1), (10**12 + 1, 0, "", "", 1, 1, "b", 1, 1)]
    return out


def slow_trie(rows):
    talks = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]
            talks[c].append(((turn is not None, turn or 0, key), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x)] for c, x in talks.items()}
    new = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, t in new.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
            if d:
                children[t[: d - 1]].add(t[:d])
        ends[t].append(c)
    leaves, saved = Counter(), Counter()
    for t, m in members.items():
        for d in range(len(t) + 1):
            leaves[t[:d]] += t not in children
            saved[t[:d]] += (len(m) - 1) * len(t[-1][1].encode()) if t else 0
    return Counter((min(m), len(t), min(members[t[:-1]]) if t else None, len(m), len(children[t]) if t in children else 0, leaves[t], saved[t], hashlib.sha256(",".join(map(str, sorted(ends.get(t, [])))).encode()).hexdigest()) for t, m in members.items())


@pytest.mark.parametrize("n, long, limit, slots", [(60, 0, 200_000, 64), (90, 12, 40, 2), (150, 3, 25, 4), (8, 0, 1, 2)])
def test_trie(spark, n, long, limit, slots):
    rows = talk_rows(n, n + long, long)
    turns = turn_rows(spark.createDataFrame(rows, TALKS).repartition(3))
    lists = rebuilt(turns, F.crc32(F.col("conv").cast("string")) % 9, F.col("conv") - F.col("conv") % 5, most=8)
    found = with_parents(trie_nodes(lists, limit, slots)).select("low", "depth", "parent_low", "n", "children", "leaves", "saved", F.coalesce("ends", F.sha2(F.lit(""), 256)))
    assert Counter(tuple(r) for r in found.collect()) == slow_trie(rows)


def test_op13_rows(spark, tmp_path):
    rows = talk_rows(40, 5, 4)
    spark.createDataFrame(rows, TALKS).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert Counter(tuple(r) for r in Q.op13_prefix_trie(spark, f"{tmp_path}/a").collect()) == slow_trie(rows)
    spark.createDataFrame([], TALKS).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert Q.op13_prefix_trie(spark, f"{tmp_path}/b").count() == 0
