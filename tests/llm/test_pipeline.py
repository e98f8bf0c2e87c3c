"""The pipeline's rows against a brute-force version, on a small folder."""

import hashlib
import random
from collections import Counter, defaultdict

from tokenizers import Tokenizer

import corpus_pipeline
from twinfold.llm.quality import measure, verdict
from twinfold.llm.queries import default_vocabulary

WORDS = "the of and to in a is that it for was on are as with his they at be this from or by not but have".split()


def texts():
    rng = random.Random(17)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(n))
    out = [(prose(120), f"s{k % 4}") for k in range(60)]
    for k in range(12):
        w = out[k][0].split()
        w[5 * k + 1] = f"edit{k}"
        out.append((" ".join(w), "s1"))
    out += [(out[k][0].upper(), None) for k in range(20, 26)] + [(out[30][0], "s9")] * 5
    return out + [(None, "s0"), ("", "s0"), ("few words", "s1"), ("again and again " * 60, "s2"), ("### " * 80, "s3")]


def test_pipeline_rows(spark, tmp_path):
    rows = [(k, t, "en", s, len(t or "")) for k, (t, s) in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    kept = [r for r in rows if verdict(measure(r[1] or ""))[1]]
    assert {k for k, *_ in rows} - {r[0] for r in kept} == {len(rows) - j for j in range(1, 6)}
    last = {r[1].encode().lower(): r for r in sorted(kept)}
    single = sorted(last.values())
    sets = {}
    for r in single:
        w = r[1].encode().lower().split()
        sets[r[0]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low = min(group[a], group[b])
                    group = {i: low if g in (group[a], group[b]) else g for i, g in group.items()}
                    changed = True
    unique = {r[0]: r for r in single if group[r[0]] == r[0]}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    times = Counter(r["doc_id"] for r in got)
    assert set(times) <= set(unique) and max(times.values()) <= 2
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, r in unique.items():
        sizes[r[3]] += len(r[1].split())
        taken[r[3]] += times[i] * len(r[1].split())
    budget, longest = 1.5 * sum(sizes.values()), max(len(r[1].split()) for r in unique.values())
    assert abs(sum(taken.values()) - budget) <= longest * len(sizes)
    library = Tokenizer.from_file(default_vocabulary())
    for r in got:
        ids = library.encode(unique[r["doc_id"]][1], add_special_tokens=False).ids
        assert r["ids"] == ids and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, hub long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == empty.columns
