"""Every stage of the pipeline against a plain rule: repeated and missing ids, null texts, clashing names."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import regex
import xxhash

import corpus_pipeline
from shiftledger.llm import toxicity
from shiftledger.llm.queries import toxicity_chain

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["__row", "row", "__rate", "rate", "__of", "of", "__copy", "copy", "meta.x", "toxic", "least", "component_id", "id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def table(spark, rows):
    full = [(*row, *(f"{n} {i}" for n in NAMES)) for i, row in enumerate(rows)]
    return full, spark.createDataFrame(full, SCHEMA).repartition(4)


def plain(df):
    assert df.columns[5:] == NAMES
    return sorted(map(tuple, df.collect()), key=str)


def documents():
    rng = random.Random(4)
    words = [f"wort{n}" for n in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 200))) for _ in range(12)]
    rows = [(n, t, "en", f"src{n % 3}", len(t)) for n, t in enumerate(texts)]
    rows += [(3, texts[1], "en", "src0", 1), (3, texts[5], "de", None, 2), (5, texts[1], "en", "src0", 3)]
    rows += [(7, "one text", "en", "src1", 1), (7, "another text entirely different", "en", "src1", 1)]
    rows += [(None, texts[2], "en", "src2", 1), (None, "only without an id here", None, None, None)] * 2
    rows += [(40, None, "en", "src0", 0), (41, "", "en", None, 0), (39, None, "en", "src0", 0)]
    rows += [(50 + n, "Kopie " + texts[0].upper(), "en", "src0", 1) for n in range(30)]
    return rows


def fingerprint(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_near_duplicates_lose_no_content(spark):
    rows, docs = table(spark, documents())
    kept = plain(corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR))
    prints = [fingerprint(row[1]) for row in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and groups[i] != groups[j]:
                groups = [groups[j] if g == groups[i] else g for g in groups]
    members = {}
    for group, row in zip(groups, rows, strict=True):
        members.setdefault(group, []).append(row)
    assert len(kept) == len(members) and set(kept) <= set(rows)
    for group in members.values():
        (row,) = [r for r in group if r in kept]
        assert row[0] == min((r[0] for r in group if r[0] is not None), default=None)
    assert kept == plain(corpus_pipeline.drop_near_duplicates(spark, docs.repartition(7), SF_DIR))


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def contaminated(text, items):
    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    for item in items:
        wanted, size = shingles(item), min(len(item), len(words))
        for start in range(len(words) - size + 1):
            found = shingles(words[start : start + size])
            both = sum((found & wanted).values())
            if both and both / (sum((found | wanted).values())) >= 0.8:
                return True
    return False


def test_contaminated_rows_go(spark):
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items = [w for w in (regex.findall(r"[\p{L}\p{N}]+", (t or "").lower()) for t in benchmark) if len(w) >= 5]
    own = documents()[:6]
    rows = [(n, f"{t[:100]} {item} {t[-90:]}", "en", "s", 1) for n, ((_, t, *_), item) in enumerate(zip(own, benchmark, strict=False))]
    rows += [(None, benchmark[3], "en", "s", 1), (0, "clean, with the id of another", "en", "s", 1), *documents()]
    rows, docs = table(spark, rows)
    kept = plain(corpus_pipeline.drop_contaminated(spark, docs, SF_DIR))
    assert kept == sorted((r for r in rows if not contaminated(r[1], items)), key=str)
    assert len(kept) == len(rows) - 7


def test_rows_are_repeated_as_the_mix_says(spark):
    rows, docs = table(spark, documents())
    sizes = {}
    for row in rows:
        words = len(regex.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
        sizes[row[3]] = sizes.get(row[3], 0) + words
    weights = {s: (5, 2, 1)[n % 3] for n, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    capped = set()
    while True:
        left = sum(sizes.values()) - 3 * sum(sizes[s] for s in capped)
        level = left / max(1, sum(w for s, w in weights.items() if s not in capped))
        more = {s for s in sizes if s not in capped and 3 * sizes[s] < weights[s] * level}
        if not more:
            break
        capped |= more
    expected = []
    for row in rows:
        size = sizes[row[3]]
        rate = (3.0 * size if row[3] in capped else weights[row[3]] * level) / size if size else 0.0
        drawn = int(hashlib.md5(f"mix|{'' if row[0] is None else row[0]}".encode()).hexdigest()[:13], 16) / 16**13
        expected += [row] * (int(rate) + (drawn < rate - int(rate)))
    assert plain(corpus_pipeline.mix_sources(spark, docs, SF_DIR)) == sorted(expected, key=str)


def test_toxic_rows_go(spark):
    labelled = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows, docs = table(spark, [tuple(r) for r in labelled] + documents())
    chain = toxicity_chain(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    chances = chain.probabilities(chain.rows([r[1] for r in rows]))[:, chain.categories.index("toxic")]
    expected = [r for r, chance in zip(rows, chances, strict=True) if chance < toxicity.THRESHOLD]
    assert plain(corpus_pipeline.drop_toxic(spark, docs, SF_DIR)) == sorted(expected, key=str)


@pytest.mark.parametrize("stage", range(5))
def test_empty_and_null_tables(spark, stage):
    """No row; and rows in which everything is null."""
    run = corpus_pipeline.STAGES[stage][1]
    _, docs = table(spark, [(None, None, None, None, None)] * 3)
    assert run(spark, docs.limit(0), SF_DIR).count() == 0
    found = run(spark, docs, SF_DIR)
    # one near-duplicate stays; a source without words is not mixed
    assert found.count() == {1: 1, 3: 0}.get(stage, 3)
    if stage < 4:
        assert found.columns == docs.columns
