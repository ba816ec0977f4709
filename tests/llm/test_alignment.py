"""Cross-tokenizer alignment against encoding whole texts one by one."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from placewise.llm import alignment

PARTS = ["a", "B", "foo", " Bar", " ", "  ", "\n", "\t", "\xa0", "é", "é", "12", "'s", "!", "<|endoftext|>", "<s>", "</s>", "<unk>",
         "<0x41>", "　", "日", "\x1c", "\r\n", "_", "\x85", "▁", "€", "\x00", "ﬁ", "😀", "\n\n"]


@pytest.fixture(scope="module")
def own():
    return alignment.Aligner(public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE))


def brute(own, text):
    """(A ids, B ids, links, groups as text) by overlapping byte ranges; nothing if the bytes differ."""
    if not text:
        return [], [], [], ""
    a, b = own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
    if any(b"".join(table[i] for i in ids) != (" " + text).encode() for table, ids in ((own.a_bytes, a), (own.b_bytes, b))):
        return [], [], [], ""
    spans = []
    for table, ids in ((own.a_bytes, a), (own.b_bytes, b)):
        end = np.cumsum([len(table[i]) for i in ids]).tolist()
        spans.append(list(zip([0, *end], end, ids)))
    found, first = [], 0
    for x, y, i in spans[0]:
        while spans[1][first][1] <= x:
            first += 1
        at = first
        while at < len(b) and spans[1][at][0] < y:
            found.append((i, spans[1][at][2]))
            at += 1
    groups, at = [], 0
    for end in sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]}):
        groups.append("|".join(",".join(str(i) for x, y, i in s if at <= x and y <= end) for s in spans))
        at = end
    return a, b, found, ";".join(groups)


def expected(own, texts):
    made = [brute(own, t) for t in texts]
    count = Counter(pair for _, _, found, _ in made for pair in set(found))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(len(a), len(b), g.count(";") + 1 if g else 0, len(found), sum(count[p] == most[p[0]] for p in found),
             sum(count[p] for p in found), hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, found, g in made]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 3000])
def test_alignment_matches_brute_force(spark, odd, rows, own, block_bytes):
    short = [r for r in rows if len(r[1] or "") < 5000]
    got = alignment.align(odd.where(F.length(F.coalesce("text", F.lit(""))) < 5000), block_bytes=block_bytes)
    assert (Counter(map(tuple, got.select("row.doc_id", *COLUMNS).collect()))
            == Counter((r[0], *x) for r, x in zip(short, expected(own, [r[1] for r in short]))))


def test_odd_texts_match_brute_force(spark, own):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 14))) for _ in range(1200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in alignment.align(docs, block_bytes=2000).select("row.doc_id", *COLUMNS).collect()}
    assert [got[k] for k in range(len(texts))] == expected(own, texts)


def test_pair_counts_have_links_from_planes(spark, own):
    texts = ["la la la la la", "la la", "la", None, "le la la"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {(r.a, r.b): (r.docs, r.links) for r in alignment.pair_counts(alignment.scan(docs)).collect()}
    made = [brute(own, t)[2] for t in texts]
    links, documents = Counter(p for x in made for p in x), Counter(p for x in made for p in set(x))
    assert got == {p: (documents[p], links[p]) for p in links}


def test_whole_long_text(spark, odd, rows):
    """A long text has the links and groups of its parts."""
    got = alignment.align(odd.where("doc_id in (10, 11)")).collect()
    assert all(r.n_links > 10_000 and r.n_groups > 1000 and r.count_sum >= r.n_links for r in got)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for n_docs in (1, 7, 300, 5000):
        keys = np.unique(rng.integers(0, 40, 4000) ** 2 * np.int64(n_docs) + rng.integers(0, n_docs, 4000))
        codes, docs = keys // n_docs, keys % n_docs
        pairs, counts, bitmaps = alignment.packed(codes, docs, n_docs)
        of, back = alignment.unpacked(counts, bitmaps, n_docs)
        order = np.lexsort((back, of))
        assert (pairs[of[order]] == codes).all() and (back[order] == docs).all()
        assert counts.sum() == len(keys) and max(map(len, bitmaps.to_pylist())) <= -(-n_docs // 8)


def test_empty_table(none):
    assert alignment.align(none).count() == 0
    assert isinstance(alignment.packed(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 3)[2], pa.BinaryArray)
