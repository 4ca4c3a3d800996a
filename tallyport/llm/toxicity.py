"""Scores toxicity with a support vector machine over a gapped subsequence kernel.

The kernel compares words by the subsequences of three and five characters they share, and as a whole. A
subsequence counts less the wider it is spread, so an insult with an inserted or missing character stays
close to the insult. Nyström landmarks turn the kernel into a short vector per word, on which a linear
machine is trained. A document's score is that of its worst sentence, a sentence's that of its worst word.
Labels are known for documents only: training starts from words whose subsequences tell toxic from clean
documents apart, and then, round by round, takes the worst word of each toxic document as its witness and the
worst words of clean documents as the counterexamples.

For scoring, landmarks and weights fold into one weight per subsequence, a table of fixed size.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyport.llm.words import utf8

CLASSES = 64
#: offsets of the characters of a subsequence from its first: three characters within five, five within six
SPREADS = (
    (0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4),
    (0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5), (0, 1, 3, 4, 5), (0, 2, 3, 4, 5),
)
FEATURES = 1 << 20
WHOLE = 2.0
DECAY = 0.7
MEMO_WORDS = 400_000
#: rows and bytes of text whose words a task reads at once
SLICE_ROWS = 500
SLICE_BYTES = 4 << 20
BLOCK = 4000
_PUNCTUATION = string.punctuation.encode()
_SPELLED = re.compile(rb"(?<!\S)(?:\S\s){2,}\S(?!\S)")


def sentence_words(text: bytes) -> set[bytes]:
    """Distinct words without punctuation, A-Z lower-cased; letters written apart also count as one word."""
    bare = text.lower().translate(None, _PUNCTUATION)
    found = set(bare.split())
    for run in _SPELLED.findall(bare):
        found.add(b"".join(run.split()))
    return found


def _codes(word: bytes) -> np.ndarray:
    """Characters as numbers below ``CLASSES``, between a start and an end mark; others than a-z share classes."""
    points = np.frombuffer(word.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = np.where((points >= 97) & (points <= 122), points - 95, 28 + points % 36)
    return np.concatenate([[0], letters, [1]]).astype(np.int64)


def subsequences(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, subsequence number and weight of every subsequence of every word; weights have norm 1 a word."""
    codes = [_codes(w) for w in words]
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    flat = np.concatenate(codes)
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    # the word as a whole is its longest subsequence
    parts = [(np.arange(len(words)), np.array([zlib.crc32(w) % FEATURES for w in words]), np.full(len(words), WHOLE))]
    for spread in SPREADS:
        last = spread[-1]
        n = len(flat) - last
        if n <= 0:
            continue
        same = owner[:n] == owner[last:]
        feature = np.zeros(n, np.int64)
        for offset in spread:
            feature = feature * CLASSES + flat[offset:n + offset]
        named = (feature[same] * 8 + len(spread)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        feature = (named >> np.uint64(44)).astype(np.int64)  # the 20 highest bits, which all characters reach
        parts.append((owner[:n][same], feature, np.full(len(feature), DECAY ** (last + 1 - len(spread)))))
    word, feature, weight = (np.concatenate(x) for x in zip(*parts))
    key = word * FEATURES + feature
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    weight = np.add.reduceat(weight, first)
    word, feature = np.divmod(key[first], FEATURES)
    norms = np.sqrt(np.bincount(word, weight ** 2, len(words)))
    return word, feature, weight / norms[word]


def _scores(words: list[bytes], table: np.ndarray) -> np.ndarray:
    word, feature, weight = subsequences(words)
    return np.bincount(word, weight * table[feature], len(words))


def _kernel(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Normalised kernel values, words by landmarks."""
    out = np.empty((len(words), len(landmarks)), np.float32)
    word, feature, weight = subsequences(words)
    for j in range(len(landmarks)):
        _, own, value = subsequences([landmarks[j]])
        table = np.zeros(FEATURES, np.float32)
        table[own] = value
        out[:, j] = np.bincount(word, weight * table[feature], len(words))
    return out


class Model(NamedTuple):
    """``table``: weight of each subsequence; ``scale`` and ``offset`` turn a worst word's score into a probability."""

    table: np.ndarray
    scale: float
    offset: float

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * (worst - self.offset), -30, 30)))


CLEAN = Model(np.zeros(FEATURES, np.float32), 1.0, 30.0)


def _parts_seen(words: Counter, documents: int) -> np.ndarray:
    """About how many documents have each subsequence, from how many have each word."""
    counts, listed = np.zeros(FEATURES), sorted(words)
    for i in range(0, len(listed), BLOCK):
        block = listed[i:i + BLOCK]
        word, feature, _ = subsequences(block)
        counts += np.bincount(feature, np.array([words[w] for w in block], float)[word], FEATURES)
    return np.minimum(counts, documents)


def _scored(words: list[bytes], table: np.ndarray) -> dict[bytes, float]:
    out: dict[bytes, float] = {}
    for i in range(0, len(words), BLOCK):
        block = words[i:i + BLOCK]
        out.update(zip(block, _scores(block, table).tolist()))
    return out


def _bent(word: bytes) -> list[bytes]:
    """The word with an x put in at each inner place; short words stay as they are."""
    letters = word.decode("utf-8", "replace")
    return [(letters[:i] + "x" + letters[i:]).encode() for i in range(1, len(letters))] if len(letters) >= 5 else []


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 30.0, rounds: int = 25) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (len(w) - 1) + [1e-3])
    share = np.where(y > 0, cost, cost * (y > 0).sum() / max(1, (y < 0).sum()) * 4)
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        part, weight = x[active], share[active][:, None]
        w = np.linalg.solve(ridge + part.T @ (part * weight), (part * weight).T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def fit(texts: list[bytes], labels: list[int], landmarks: int = 320, rounds: int = 3) -> Model:
    """Train on whole texts with document labels. Without both classes nothing can be learnt and all is clean."""
    table, clean_at, hard, floor = None, {}, [], 0.0
    shared: dict[bytes, bytes] = {}  # one object per word
    bags = [sorted(shared.setdefault(w, w) for w in sentence_words(t)) for t in texts]
    toxic = [b for b, y in zip(bags, labels) if y == 1 and b]
    clean = [b for b, y in zip(bags, labels) if y == 0 and b]
    if not toxic or not clean:
        return CLEAN
    clean_words = Counter(w for bag in clean for w in bag)
    known, clean_parts = sorted(clean_words), _parts_seen(clean_words, len(clean))
    plain = known[::max(1, len(known) // 4000)]
    witnesses: Counter = Counter()
    unexplained = toxic
    for _ in range(rounds):
        def rarer(found, in_clean):
            """How much rarer in clean documents than in unexplained ones; less for what was seldom seen."""
            odds = np.log((found + 0.5) / (len(unexplained) + 1)) - np.log((in_clean + 0.5) / (len(clean) + 1))
            return np.clip(odds, 0, None) * found / (found + 5)

        seen = Counter(w for bag in unexplained for w in bag)
        words = sorted(seen)
        as_word = rarer(np.array([seen[w] for w in words], float), np.array([clean_words[w] for w in words], float))
        as_parts = _scored(words, rarer(_parts_seen(seen, len(unexplained)), clean_parts))
        at = {w: as_parts[w] + odds for w, odds in zip(words, as_word.tolist())}
        # a document whose most telling word tells far less than elsewhere has no witness yet
        usual = float(np.median([max(at[w] for w in bag) for bag in unexplained]))
        floor = floor or max(1.6, 0.25 * usual)
        alone = dict(zip(words, as_word.tolist()))
        before = len(witnesses)
        for bag in unexplained:
            least, apart = max(0.7 * max(at[w] for w in bag), 0.5 * usual, floor), 0.95 * max(alone[w] for w in bag)
            witnesses.update(w for w in bag if at[w] >= least or alone[w] >= max(apart, 2.0) and seen[w] > 2)
        if not witnesses:
            return CLEAN
        if len(witnesses) == before and hard:
            break
        insults = sorted(witnesses, key=lambda w: (-witnesses[w], w))[:3000]
        # the commonest insults also with one character put in, unless clean documents have the result
        bent = [v for w in insults[:200] for v in _bent(w) if v not in clean_words]
        for _ in range(3):  # each time with the clean words that the last machine took for the worst
            marks = insults[:landmarks // 2]
            marks = marks + (hard or plain)[:landmarks - len(marks)]
            gram = _kernel(marks, marks).astype(np.float64)
            value, vector = np.linalg.eigh((gram + gram.T) / 2)
            good = value > 1e-4 * value.max()
            whiten = vector[:, good] / np.sqrt(value[good])
            words = insults + bent + hard + plain
            y = np.concatenate([np.ones(len(insults) + len(bent)), -np.ones(len(hard) + len(plain))])
            weights = _machine(_kernel(words, marks) @ whiten.astype(np.float32), y)
            table, bias = np.zeros(FEATURES), weights[-1]
            for mark, alpha in zip(marks, whiten @ weights[:-1]):
                _, feature, weight = subsequences([mark])
                table[feature] += alpha * weight
            clean_at = _scored(known, table)
            worst_first = sorted(clean_at, key=lambda w: (-clean_at[w], w))[:2000]
            hard = worst_first + sorted(set(hard) - set(worst_first))[:4000]
        everything = clean_at | _scored(sorted({w for bag in toxic for w in bag if w not in clean_at}), table)
        unexplained = [bag for bag in toxic if max(everything[w] for w in bag) < -bias]
        if len(unexplained) < 3:
            break
    worst = lambda side: np.array([max(everything[w] for w in bag) for bag in side])
    high, low = np.sort(worst(toxic)), np.sort(worst(clean))
    # the cut that errs least on the training documents, false alarms counting ten times as much, in the middle of the gap around it
    cuts = np.concatenate([high, low, [-bias]])
    errors = np.searchsorted(high, cuts) / len(high) + 10 * (len(low) - np.searchsorted(low, cuts)) / len(low)
    cut = cuts[errors.argmin()]
    above = np.concatenate([high, low])[np.concatenate([high, low]) >= cut]
    below = np.concatenate([high, low])[np.concatenate([high, low]) < cut]
    offset = (above.min() + below.max()) / 2 if len(above) and len(below) else cut
    return Model(table.astype(np.float32), 6.0, float(offset))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> DataFrame:
    """``text`` and ``toxic`` of at most ``per_class`` labelled documents of each class, the first by hash of the id.

    Rows with a null id, text or label, or whose id's CRC-32 is divisible by 5 (held out), are never used.
    """
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    usable = docs.filter(~held_out & F.col("text").isNotNull()).select("doc_id")
    labelled = labels.filter(~held_out & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").join(usable, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = labelled.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        labelled.filter("toxic = 0").orderBy(*order).limit(per_class))
    # at most 2 * per_class ids
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> Model:
    """Fit on a bounded sample: ``per_class`` labelled rows of each class come to the driver, no more."""
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in training_rows(docs, labels, per_class).collect())
    return fit([t.encode() for _, t, _ in rows], [y for _, _, y in rows])


def slices(batch: pa.RecordBatch, at: int, rows: int = SLICE_ROWS, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` of at most ``rows`` rows and ``limit`` bytes of the text at ``at`` (a longer text alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = 0
    while begin < len(sizes):
        end, used = begin, 0
        while end < len(sizes) and end - begin < rows and (end == begin or used + sizes[end] <= limit):
            used += sizes[end]
            end += 1
        yield batch.slice(begin, end - begin)
        begin = end


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1. Null and empty texts have no word and score like the mildest word, near 0.

    Each Arrow batch is cut into slices of at most ``SLICE_ROWS`` rows and ``SLICE_BYTES`` of text before any word is
    read, so a task holds the words of one slice at a time.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns
    schema = StructType(docs.schema.fields + [StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, float] = {}
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, at):
                bags = [sentence_words(t or b"") for t in utf8(part.column(at))]
                if len(memo) > MEMO_WORDS:  # only a memo: what is forgotten is computed again
                    memo.clear()
                new = sorted({w for bag in bags for w in bag if w not in memo})
                memo.update(_scored(new, model.table))
                worst = np.array([max(map(memo.__getitem__, bag)) if bag else -30.0 for bag in bags], float)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.probability(worst))], [*names, "score"])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on), learnt from ``labels``.

    Only the text is an input of the score. Columns with these names are replaced, others pass through. Ids that occur several times get one result per row.
    """
    scored = score(docs, train(docs, labels, per_class))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
