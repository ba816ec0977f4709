"""Phrase mining against counting every sequence of words."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewise.llm import phrases
from tests.conftest import SF_DIR


def brute(rows, threshold, first=phrases.FIRST, covered=80):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = Counter()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        most = Counter()
        for q, b in candidates.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    most[q[i:i + size]] = max(most[q[i:i + size]], b)
        kept = []
        for p, a in candidates.items():
            if p in most and 100 * most[p] >= covered * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            out[lang, rank, p.decode(), -a, l, r, n[lang], -score] += 1
    return out


def mined(docs, **options):
    found = phrases.collocations(docs, **options)
    return Counter(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("threshold,shards,slots,block_words", [
    (4, 3, 1 << 24, 2 << 20), (2, 1, 1 << 12, 3000), (3, 5, 1 << 14, 20_000), (2, 2, 64, 1000)])
def test_documents_match_brute_force(spark, threshold, shards, slots, block_words):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    got = mined(docs, threshold=threshold, shards=shards, n_slots=slots, block_words=block_words)
    assert got == brute(rows, threshold) and len(got) > 100


def test_odd_rows_match_brute_force(odd, rows):
    assert mined(odd, threshold=2, shards=2, first=50) == brute([(r[1], r[2]) for r in rows], 2, 50)


def test_random_words_match_brute_force(spark):
    """Few words, so that phrases overlap themselves, hide each other and tie."""
    rng = np.random.default_rng(3)
    parts = ["a", "b", "A", "c", "\xa0", "é", "x\x1cy", ".", "\t", "\n", "\x0b", "  ", ",", "\x85"]
    rows = [(" ".join(rng.choice(parts, rng.integers(0, 30))), [None, "und", "en"][k % 3]) for k in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for threshold in (2, 30):
        assert mined(docs, threshold=threshold) == brute(rows, threshold)


def test_each_phrase_is_counted_in_one_full_cycle():
    """A table that fills up by chance activates phrases early, but each shard counts a phrase once."""
    rng, shards = np.random.default_rng(4), 3
    words = [phrases.CUT, *(b"w%d" % k for k in range(6))]
    blocks = [np.append(rng.integers(0, 7, 200), 0).astype(np.int32) for _ in range(shards)]
    hashes = phrases.word_hash(b"en", words)
    counts, table = defaultdict(Counter), np.full(64, phrases.NEVER, dtype=np.uint8)
    for step in range(4 * shards):
        at = rng.integers(0, 64, 12)
        table[at] = np.minimum(table[at], step)
        for size, _, columns, n in phrases.block_counts(hashes, blocks[step % shards], table, step, shards):
            for phrase, k in zip(zip(*columns), n):
                assert step % shards not in counts[tuple(phrase)]
                counts[tuple(phrase)][step % shards] += int(k)
    whole = Counter()
    for block in blocks:
        for size in range(1, 5):
            whole.update(p for i in range(len(block) - size + 1) if 0 not in (p := tuple(block[i:i + size])))
    pairs = [p for p in counts if len(p) == 2]
    assert pairs and all(sum(counts[p].values()) == whole[p] for p in counts if len(p) == 1)


def test_steps_fit_the_table(spark, none):
    with pytest.raises(ValueError):
        phrases.collocations(none, shards=phrases.MOST_SHARDS + 1)


def test_empty_table(none):
    assert phrases.collocations(none).count() == 0


def test_exact_scores_of_large_counts(spark):
    """Products beyond 64 bits."""
    big = 4_000_000_000_000_000_007
    frequent = spark.createDataFrame([("en", b"a", 1, big), ("en", b"b", 1, big), ("en", b"a b", 2, big - 10)],
                                     "lang string, phrase binary, size int, n bigint")
    frequent = frequent.withColumn("phrase", F.col("phrase"))
    row = phrases.scored(frequent).first()
    assert row.score == 2_000_000 * (big - 10) // (2 * big)
