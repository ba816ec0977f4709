"""Secret scans: candidates by shape, false positives removed by a random forest.

Every run of key-like characters with a digit or a known prefix, and every value assigned to a name, is a
candidate. Its features are those that tell keys from ordinary strings: length, character
transitions (how usual each step from character to character is in the corpus, and how often
the class changes), coverage by a dictionary of the corpus's words, signs of a path, and
the words next to it. A Spark ML random forest, trained from labelled findings, gives each
candidate its probability of being a secret.

The words around it count by themselves (the ``WORDS_BEFORE`` before and ``WORDS_AFTER`` after it, hashed to cells) and
through the list of credential names.

Statistics come from all documents: the table of character steps has ``N_CLASSES`` squared
cells, and the dictionary keeps the ``DICTIONARY_WORDS`` most frequent words of three letters
or more, so both have a fixed size, whatever the corpus. The forest is fit on at most
``TRAIN_ROWS`` labelled findings of each label, those of the smallest hash. Where no labelled
findings are given, ``rule_labels`` labels the candidates by rules on value, name and the words
before; what they leave open is not learned from. If one label is missing there is nothing to learn:
the label rule decides alone, and what it leaves open is reported as a secret with score 0.5.

Defined results: a null or empty text has no candidates; repeated rows give repeated findings;
an empty table gives an empty table; of the input only the id and text columns are read; a very long text is a block
of its own and a very long value one candidate; ties of the training sample's hash go by id and place. Values
are reported by position and SHA-256, never in clear.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.blocks import as_bytes, over_blocks, stored, whole_text

LEAST = 16
LEAST_ASSIGNED = 8
#: A run of key characters, or a quoted or bare value after = or : and a name (quoted or not), or after Bearer.
CANDIDATE = re.compile(
    r"(?P<name>[A-Za-z][A-Za-z0-9_\-]{1,40})[\"']?[ \t]{0,2}[:=][ \t]{0,2}[\"']?(?:(?i:bearer|basic|token)[ \t]{1,2})?"
    r"(?P<value>[A-Za-z0-9+/_=\-.~!@#%%^]{%d,})"
    r"|(?P<scheme>(?i:bearer))[ \t]{1,2}[\"']?(?P<shown>[A-Za-z0-9+/_=\-.~]{%d,})"
    r"|(?P<run>[A-Za-z0-9+/_=\-]{%d,})" % (LEAST_ASSIGNED, LEAST_ASSIGNED, LEAST))
HAS_DIGIT = re.compile("[0-9]")
LETTERS = re.compile(b"[a-z]{3,}")
NAMES = re.compile("token|secret|passw|pwd|api|key|auth|credential|bearer|private", re.I)
#: Values that tell by themselves what they are.
PREFIXED = (r"^((AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}"
            r"|[sr]k_(live|test)_[A-Za-z0-9]{10,}|xox[abprs]-[A-Za-z0-9-]{8,}|AIza[A-Za-z0-9_-]{30,})")
AROUND = 40

N_CLASSES = 38      # a-z, 0-9, capital, other
DICTIONARY_WORDS = 2000
TRAIN_ROWS = 10_000
TREES, DEPTH, SEED = 30, 6, 17
FEATURES = ("n_chars", "step_mean", "step_min", "class_changes", "digit_share", "upper_share", "other_share",
            "distinct_share", "coverage", "separators", "in_path", "assigned", "quoted", "named", "named_before")
#: The words next to a candidate, as features of their own: numbers of words that fall into each of so many hash
#: cells, those before and those after it apart. The forest learns from the labelled findings which of them tell.
CELLS = 24
WORDS_BEFORE, WORDS_AFTER = 3, 3
NEXT_WORD = re.compile(r"[^\W\d_]+")
STATISTICS = "kind string, cell bigint, n bigint"


# ---------------------------------------------------------------- corpus statistics

CLASS_OF = np.full(256, N_CLASSES - 1, dtype=np.int64)
CLASS_OF[ord("a"):ord("z") + 1] = np.arange(26)
CLASS_OF[ord("0"):ord("9") + 1] = 26 + np.arange(10)
CLASS_OF[ord("A"):ord("Z") + 1] = 36


LONGEST = 63


def word_code(word: bytes) -> int:
    """A number for each word of fewer than ``LONGEST`` small letters, modulo 2 ** 64; its last digit to base 64 is the length."""
    code = 0
    for b in word:
        code = code * 27 + b - 96
    code = (code * 64 + len(word)) % (1 << 64)
    return code - (1 << 64) if code >> 63 else code


def _statistics(block: dict[str, pa.Array]) -> dict[tuple[str, int], int]:
    """Counts of character steps, and of words of three letters or more, in a block."""
    data = b"\n".join(as_bytes(block["text"])) + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    steps = np.zeros(N_CLASSES * N_CLASSES, dtype=np.int64)
    words: Counter = Counter()
    for at in range(0, len(raw), 1 << 20):  # one byte of overlap carries the step between pieces
        classes = CLASS_OF[raw[at:at + (1 << 20) + 1]]
        steps += np.bincount(classes[:-1] * N_CLASSES + classes[1:], minlength=len(steps))
    letters = (CLASS_OF[np.frombuffer(data.lower(), dtype=np.uint8)] < 26) | (raw >= 128)
    edge = np.flatnonzero(np.diff(letters.astype(np.int8), prepend=0, append=0))
    first, end = edge[::2], edge[1::2]
    small = np.frombuffer(data.lower(), dtype=np.uint8).astype(np.int64) - 96
    for size in np.unique(end - first):
        if not 3 <= size < LONGEST:
            continue
        own = first[end - first == size]
        place = own[:, None] + np.arange(size)
        plain = small[place]
        plain = plain[((plain > 0) & (plain < 27)).all(axis=1)]
        codes = np.zeros(len(plain), dtype=np.int64)
        for k in range(size):  # wraps as word_code does
            codes = codes * 27 + plain[:, k]
        codes = codes * 64 + size
        for code, n in zip(*np.unique(codes, return_counts=True)):
            words[int(code)] += int(n)
    out = {("step", int(c)): int(steps[c]) for c in np.flatnonzero(steps)}
    return out | {("word", code): n for code, n in words.items()}


def corpus_statistics(docs: DataFrame, text: str | Column = "text") -> tuple[np.ndarray, frozenset[int]]:
    """Log10 probability of each character step, and the dictionary, from all documents."""
    from placewise.llm.blocks import BLOCK_BYTES, slices

    def run(batches):
        for block in slices(batches, "text", BLOCK_BYTES):
            made = _statistics({"text": block.column("text")})
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in made], pa.string()),
                                              pa.array([c for _, c in made], pa.int64()),
                                              pa.array(list(made.values()), pa.int64())], names=["kind", "cell", "n"])

    counts = stored(docs.select(whole_text(text).alias("text")).mapInArrow(run, STATISTICS)
                    .groupBy("kind", "cell").agg(F.sum("n").alias("n")), "secret-statistics")
    steps = np.ones(N_CLASSES * N_CLASSES)
    for row in counts.where("kind = 'step'").collect():  # at most N_CLASSES squared rows
        steps[row.cell] += row.n
    steps = steps.reshape(N_CLASSES, N_CLASSES)
    top = counts.where("kind = 'word'").orderBy(F.desc("n"), "cell").limit(DICTIONARY_WORDS).collect()
    return np.log10(steps / steps.sum(axis=1, keepdims=True)), frozenset(r.cell for r in top)


# ---------------------------------------------------------------- candidates

def covered_places(small: bytes, dictionary: frozenset[int]) -> np.ndarray:
    """Which characters of a lower-case value lie in a word of the dictionary."""
    covered = np.zeros(len(small), dtype=bool)
    sizes = sorted({code & 63 for code in dictionary})
    for letters in LETTERS.finditer(small):
        first, end = letters.span()
        if end - first <= LONGEST:
            for size in sizes:
                for at in range(first, end - size + 1):
                    if word_code(small[at:at + size]) in dictionary:
                        covered[at:at + size] = True
            continue
        # A long run: the codes of all places at once, for each size.
        run, known = np.frombuffer(small[first:end], dtype=np.uint8).astype(np.int64) - 96, np.array(sorted(dictionary), dtype=np.int64)
        for size in sizes:
            codes = np.zeros(end - first - size + 1, dtype=np.int64)
            for k in range(size):  # wraps as word_code does
                codes = codes * 27 + run[k:k + len(codes)]
            for at in np.flatnonzero(np.isin(codes * 64 + size, known)):
                covered[first + at:first + at + size] = True
    return covered


def neighbours(before: str, after: str) -> list[float]:
    """Words next to a candidate by hash cell: the last before it, then the first after it."""
    cells = np.zeros(2 * CELLS)
    for side, words in enumerate((NEXT_WORD.findall(before)[-WORDS_BEFORE:], NEXT_WORD.findall(after)[:WORDS_AFTER])):
        for word in words:
            cells[side * CELLS + zlib.crc32(word.lower().encode()) % CELLS] += 1
    return cells.tolist()


def features(value: str, before: str, after: str, name: str | None, steps: np.ndarray, dictionary: frozenset[int]) -> list[float]:
    raw = np.frombuffer(value.encode(), dtype=np.uint8)
    classes = CLASS_OF[raw]
    likely = steps[classes[:-1], classes[1:]]
    kind = np.select([classes < 26, classes < 36, classes == 36], [0, 1, 2], 3)
    small = value.lower().encode()
    covered = covered_places(small, dictionary)
    n = len(raw)
    return [float(n), float(likely.mean()), float(likely.min()), float((kind[1:] != kind[:-1]).sum() / n),
            float((kind == 1).sum() / n), float((kind == 2).sum() / n), float((kind == 3).sum() / n),
            len(set(value)) / n, float(covered.sum() / n), float(value.count("/") + value.count(".")),
            float("://" in before or before.endswith(("/", "\\", "@", "www.")) or after.startswith((".", "/", "@"))),
            float(name is not None), float(before[-1:] in ("\"", "'") and after[:1] in ("\"", "'")),
            float(bool(name and NAMES.search(name))), float(bool(NAMES.search(before))), *neighbours(before, after)]


def candidates_of(text: str) -> list[tuple[int, str, str | None]]:
    """(start, value, assigned name) of each candidate."""
    out = []
    for m in CANDIDATE.finditer(text):
        group = next(g for g in ("value", "shown", "run") if m[g] is not None)
        name = m["name"] or m["scheme"]
        value = m[group] if group == "run" else m[group].rstrip(".")
        if HAS_DIGIT.search(value) or re.search(PREFIXED, value) or (group == "value" and NAMES.search(name)):
            out.append((m.start(group), value, name))
    return out


def candidates(docs: DataFrame, steps: np.ndarray, dictionary: frozenset[int], doc_id: str = "doc_id",
               text: str | Column = "text") -> DataFrame:
    """doc_id, start, n_chars, name, value, features of every candidate of every whole text."""
    context = docs.sparkSession.sparkContext.broadcast((steps, dictionary))
    item = pa.struct([("start", pa.int64()), ("n_chars", pa.int64()), ("name", pa.string()), ("value", pa.string()),
                      ("features", pa.list_(pa.float64()))])

    def step(block: dict[str, pa.Array]) -> list:
        known, words = context.value
        out = []
        for t in block["text"].to_pylist():
            out.append([{"start": a, "n_chars": len(v), "name": name, "value": v,
                         "features": features(v, t[max(0, a - AROUND):a], t[a + len(v):a + len(v) + AROUND], name, known, words)}
                        for a, v, name in candidates_of(t)])
        return [pa.array(out, pa.list_(item))]

    fields = "found array<struct<start:bigint,n_chars:bigint,name:string,value:string,features:array<double>>>"
    found = over_blocks(docs, {"text": whole_text(text)}, step, fields, [doc_id])
    return found.select(F.col(f"row.`{doc_id}`").alias("doc_id"), F.explode("found").alias("c")).select("doc_id", "c.*")


# ---------------------------------------------------------------- labels and forest

def rule_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 a secret, 0 a false alarm, null where the rules cannot tell.

    A known key prefix is a secret whatever is around it; so are a long hexadecimal or base-64 value
    under a credential name or after one in the text, and a shorter value of letters and digits
    assigned to a credential name. Paths, and values that neither look like a key nor stand by a
    credential name, are false alarms.
    """
    value, name, feature = F.col("value"), F.coalesce("name", F.lit("")), lambda n: F.col("features")[FEATURES.index(n)] > 0
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    shaped = mixed & (value.rlike("^[0-9a-fA-F]{32,}$") | value.rlike("^[A-Za-z0-9+/_-]{24,}={0,2}$"))
    prefixed, path = value.rlike(PREFIXED), feature("in_path") | value.rlike("^[./]*/|://")
    named = name.rlike("(?i)" + NAMES.pattern)
    by_context = named | feature("named_before")
    label = (F.when(prefixed, 1.0).when(path, 0.0).when(by_context & shaped, 1.0).when(named & mixed, 1.0)
             .when(~by_context & ~shaped, 0.0))
    return found.withColumn("label", label)


def fit_forest(labelled: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """A forest of at most ``rows`` findings of each label; None if one label is missing."""
    order = [F.xxhash64("doc_id", "start", "value"), F.col("doc_id"), F.col("start")]
    one, none = (labelled.where(F.col("label") == v).orderBy(*order).limit(rows) for v in (1.0, 0.0))
    train = stored(one.unionByName(none).select("label", "features"), "labelled-findings")
    if train.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(train.withColumn("vector", array_to_vector("features")))


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id",
                 text: str | Column = "text") -> DataFrame:
    """All candidates with score and verdict: doc_id, start, n_chars, name, value_sha256, score, secret.

    ``labelled`` has doc_id, start, label (1 a secret, 0 a false alarm) of reviewed findings.
    """
    steps, dictionary = corpus_statistics(docs, text)
    found = stored(candidates(docs, steps, dictionary, doc_id, text), "secret-candidates")
    by_rule = rule_labels(found)
    known = by_rule if labelled is None else found.join(labelled.select("doc_id", "start", "label"), ["doc_id", "start"])
    model = fit_forest(known)
    if model is None:
        scored = by_rule.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = (model.transform(found.withColumn("vector", array_to_vector("features")))
                  .withColumn("score", vector_to_array("probability")[1]))
    return scored.select("doc_id", "start", "n_chars", "name", F.sha2("value", 256).alias("value_sha256"), "score",
                         (F.col("score") >= 0.5).alias("secret"))
