"""Hostile inputs, repeated identifiers, many shards, large counts."""

import html
import math
import random
import resource
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinfold.llm.bpe import Encoder, load_automaton
from twinfold.llm.exact_dedup import drop_copies, exact_groups
from twinfold.llm.html_text import characters, extract_pages, main_text
from twinfold.llm.near_dedup import keep_one, near_groups
from twinfold.llm.ngram_lm import MappedModel, flat, mapped, narrow, save, score_documents, train
from twinfold.llm.queries import default_vocabulary
from twinfold.llm.shared import new_path

PROSE = "The storm that came over the hills in the night was one of the worst that people in the village had seen for many years."


def test_numeric_references_of_any_length():
    assert characters("&#" + "9" * 5000 + ";x") == "�x" == characters("&#x" + "f" * 5000 + ";x") == characters("&#X0000000110000;x")
    assert characters("&#" + "0" * 9000 + "65;") == "A" == characters("&#x" + "0" * 9000 + "41;") == characters("&#00000000065")
    for raw in ("&#65;&#x41;", "&#1114111;", "&#1114112;", "&#0;", "&#x80;", "&amp;#12345678901;", "&#;", "&#x;", "&# 1;", "&#12345678"):
        assert characters(raw) == html.unescape(raw)


def hostile():
    long = "<article><p>" + PROSE + "</p></article>"
    return {
        "decimal": long.replace("storm", "&#" + "1" * 6000 + ";"), "padded": long.replace("storm", "&#" + "0" * 6000 + "65;"), "hex": long.replace("storm", "&#x" + "a" * 6000 + ";"),
        "deep": "<div>" * 30_000 + long + "</div>" * 30_000, "closes": long + "</p>" * 50_000, "opens": long + "<" * 200_000, "quotes": long + "<p a='" + "x" * 200_000, "comment": long + "<!-- " + "- " * 100_000, "script": "<script>" * 5000 + long,
        "marks": long + "<p class='" + "nav-" * 50_000 + "'>x</p>", "ands": long + "&" * 200_000, "lists": long + "<li>" * 30_000, "nul": "\x00" * 1000 + long, "tables": "<table>" * 5000 + "<tr><td>" * 5000 + long, "cdata": long + "<![CDATA[" * 20_000,
    }


def test_one_hostile_page_costs_only_itself(spark):
    good = "<html><body><nav><a href='/'>Home</a></nav><article><p>" + PROSE + "</p></article></body></html>"
    pages = hostile()
    rows = [(k, "u", p) for k, p in enumerate(pages.values())] + [(1000 + k, "u", good) for k in range(40)]
    got = {r["id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).collect()}
    assert len(got) == len(rows) and all(got[1000 + k] == PROSE for k in range(40))
    assert got[list(pages).index("padded")] == PROSE.replace("storm", "A") and got[list(pages).index("hex")] == PROSE.replace("storm", "�")
    assert main_text(pages["decimal"]) == PROSE.replace("storm", "�") and PROSE in got[list(pages).index("deep")]


DOCS = "doc_id long, text string, source string, kept_id long, row string"


def test_one_row_of_each_group_where_identifiers_repeat(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(n))
    text, other, third = prose(120), prose(90), prose(100)
    rows = [(1, text, "s", 1, "r"), (1, text, "s", 1, "r"), (2, text + " zz", "s", 1, "r"), (2, other, "s", 1, "r"), (3, third, "a", 1, "r"), (3, third, "b", 2, "r"), (4, third + " x", "s", 1, "r"), (5, "", "s", 1, "r"), (5, "", "s", 1, "r"), (None, "one two", "s", 1, "r"), (None, "one two", "s", 1, "r"), (None, third + " y", "s", 1, "r"), (6, "alone and unlike", "s", 1, "r")]
    kept = keep_one(spark.createDataFrame(rows, DOCS).repartition(3))
    assert kept.columns == ["doc_id", "text", "source", "kept_id", "row"]
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert got == Counter({(1, text): 1, (2, other): 1, (3, third): 1, (5, ""): 2, (None, "one two"): 1, (6, "alone and unlike"): 1})
    again = Counter((r["doc_id"], r["text"], r["source"]) for r in keep_one(spark.createDataFrame(rows[::-1], DOCS)).collect())
    assert again == Counter((r["doc_id"], r["text"], r["source"]) for r in kept.collect())  # the same row in any order
    marks = Counter((r["id"], r["component_id"], r["kept"]) for r in near_groups(spark.createDataFrame(rows, DOCS)).collect())
    assert marks[2, 1, False] == 1 and marks[2, 2, True] == 1 and marks[1, 1, True] == 2


def test_keep_one_of_rows_without_repeats_and_of_none(spark):
    rows = [(k, "a b c d e f g h" if k < 3 else f"x{k} y{k}", "s", 1, "r") for k in range(6)]
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(r["doc_id"] for r in keep_one(df).collect()) == [0, 3, 4, 5]
    assert keep_one(df.limit(0)).count() == 0


def test_counts_beyond_32_bits(tmp_path):
    assert narrow(np.array([1, 2**32 - 1])).dtype == np.uint32 and narrow(np.array([2**32])).dtype == np.int64
    keys, large, small = np.array([3, 9, 2**63 + 5], np.uint64), np.array([1, 2**32, 2**40]), np.array([7, 8, 9])
    save(str(tmp_path), "words-0", keys, narrow(large), narrow(small))
    found = mapped(f"{tmp_path}/words-0.bin")
    assert [x.tolist() for x in found] == [keys.tolist(), large.tolist(), small.tolist()]
    assert mapped(f"{tmp_path}/words-1.bin") is None
    model = MappedModel(str(tmp_path), 1, {f"{c}{k}": 1 for c in "na" for k in (1, 2, 3, 4)})
    assert [x.tolist() for x in model.look_up(np.array([9, 10, 2**63 + 5], np.uint64), "words", 2)] == [[2**32, 0, 2**40], [8, 0, 9]]


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(8)
    words = ["the", "of", *[f"w{k}" for k in range(300)]]
    return [(k, " ".join(rng.choices(words, weights=[200, 90, *[1] * 300], k=rng.randrange(1, 200)))) for k in range(150)]


def test_many_shards_with_few_file_handles(spark, talk):
    """400 shards, of which a worker has a bounded number open: the same scores as with one shard."""
    docs = spark.createDataFrame(talk, "doc_id long, text string")
    folder = new_path(spark, "many-shards")
    totals = train(docs.select("text"), folder, 400)
    one = {r["id"]: r["score"] for r in score_documents(docs, F.lit(False), shards=1).collect()}
    before, words, ends = flat(pa.array([t for _, t in talk]))
    limits = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, limits[1]))
    try:
        model = MappedModel(folder, 400, totals)
        score = model.score(before, words)[2]
        assert len(model.open) <= 48
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, limits)
    sums = np.add.reduceat(score, np.concatenate([[0], ends[:-1]]))
    assert all(math.isclose(one[k], x, rel_tol=1e-9) for (k, _), x in zip(talk, sums))


def test_probabilities_sum_to_one_over_shards(spark, talk):
    """After a frequent word, a rare one, the start and an unseen word."""
    docs = spark.createDataFrame(talk, "doc_id long, text string")
    folder = new_path(spark, "sums")
    model = MappedModel(folder, 7, train(docs.select("text"), folder, 7))
    _, known, _ = flat(pa.array([t for _, t in talk]))
    every = np.concatenate([np.unique(known), np.array([12345], np.uint64)])  # and one unknown word for all others
    firsts, _, _ = flat(pa.array(["the w5 never"]))
    for first in firsts:
        p = 10 ** model.score(np.full(len(every), first), every)[2]
        assert abs(p.sum() - 1) < 1e-9


def test_any_number_of_memtables_gives_the_same_groups(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, rng.choice(["A b", "a B", "c", "", None, f"own {k}"]), "s", 1, "r") for k in range(60)]
    df = spark.createDataFrame(rows, DOCS)
    found = []
    for size in (50_000, 25, 1):  # one, three, five
        monkeypatch.setattr("twinfold.llm.exact_dedup.MEMTABLE_ROWS", size)
        found.append((Counter(tuple(r) for r in exact_groups(df, keep="largest").collect()), Counter(r["doc_id"] for r in drop_copies(df, keep="largest").collect())))
    assert found[0] == found[1] == found[2] and len(found[0][1]) == len({(t or "").lower() for _, t, *_ in rows})


def test_long_words_are_quick():
    from tokenizers import Tokenizer

    path = default_vocabulary()
    automaton, library = load_automaton(path), Tokenizer.from_file(path)
    encoder = Encoder(automaton)
    rng = random.Random(5)
    for word in ("ab" * 100_000, " " * 200_000, "1" * 200_000, "".join(rng.choice("ab") for _ in range(200_000)), "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(100_000)), "\u00e9" * 50_000):
        began = time.perf_counter()
        automaton.encode_word(word.encode())
        assert time.perf_counter() - began < 3, word[:9]
        text = word[:20_000]
        assert encoder.encode(text) == ",".join(map(str, library.encode(text, add_special_tokens=False).ids)), word[:9]
