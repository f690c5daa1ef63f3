"""Toxicity: a linear-chain conditional random field over tokens.

Each token is clean (0) or toxic (1). Emissions come from hashed features of
the token's form, transitions from a 2 x 2 table. The marginals of the
forward-backward pass give the offending tokens and, aggregated, the score.

Training knows only which documents are toxic. Token labels are derived from
that: a token of a toxic document is labelled toxic if one of its features is
significantly bound to toxic documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from callstats.llm.common import class_sample

#: Bounds of the training sample, by class: documents, and characters of all of
#: them together (texts are taken whole, of any length, while there is room).
SAMPLE_PER_CLASS = 2000
TRAIN_CHARS = 8_000_000
#: Steps that fewer chains than this go through are taken chain by chain.
FEW = 12
BUCKETS = 1 << 18
MASK = BUCKETS - 1
TOKEN = re.compile(r"\w+")
PREDICT_AT = 0.7


def features(token: str) -> list[int]:
    """Hashes of the token's form in lower case: whole, its beginnings and its
    endings. Beginnings and endings are marked as parts, so that a stem on its
    own and the same stem with an ending are told apart."""
    w = token.lower()
    out = ["=" + w]
    out += ["<" + w[:k] for k in (4, 5, 6, 7, 8) if len(w) > k]
    out += [">" + w[-k:] for k in (4, 6) if len(w) > k]
    return [zlib.crc32(f.encode("utf-8")) for f in out]


@dataclass
class Crf:
    """Weights: ``emit`` per feature bucket (score of toxic against clean),
    ``bias``, ``trans`` [from, to], and the calibration of the document score."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, dtype=np.float32))
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: tuple[float, ...] = (0.0, 0.5, 0.5)

    def __post_init__(self):
        self._known: dict[str, float] = {}
        self._weights = self.emit.tolist()

    def emissions(self, tokens: list[str]) -> np.ndarray:
        known, weights = self._known, self._weights
        if len(known) > 500_000:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = self.bias + sum([weights[f & MASK] for f in features(t)])
        return np.fromiter(map(known.__getitem__, tokens), np.float64, len(tokens))


def forward_backward(u: np.ndarray, length: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal P(toxic) of each token, and the expected number of each
    transition. ``u`` holds the tokens' scores of toxic against clean, chain
    after chain; ``length`` the chains' lengths.

    With two states only the ratios of the forward and backward messages are
    needed. All chains advance together, the longest first, so each step works
    on the chains that are long enough for it.
    """
    n, longest = len(u), int(length.max(initial=0))
    first = np.cumsum(length) - length
    by = np.argsort(-length, kind="stable")
    first, length = first[by], length[by]
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    offset = np.append(0, np.cumsum(active))
    token = np.concatenate([first[: active[k]] + k for k in range(longest)]) if longest else np.zeros(0, np.int64)
    e = np.exp(np.clip(u, -40, 40))[token]
    (t00, t01), (t10, t11) = np.exp(trans)
    fwd, bwd = np.empty(n), np.ones(n)
    pairs = np.zeros((2, 2))
    # All chains in step while they are many; a few long ones go on singly.
    together = int(np.searchsorted(-active, -FEW, side="right")) if longest else 0
    for k in range(together):
        a, b = offset[k], offset[k + 1]
        if k == 0:
            fwd[a:b] = e[a:b]
        else:
            r = fwd[offset[k - 1] : offset[k - 1] + b - a]
            fwd[a:b] = e[a:b] * (t01 + r * t11) / (t00 + r * t10)
    for chain in range(int(active[together]) if together < longest else 0):
        at = offset[together : length[chain]] + chain
        before = float(fwd[offset[together - 1] + chain]) if together else None
        odds, of = e[at].tolist(), []
        for x in odds:
            before = x if before is None else x * (t01 + before * t11) / (t00 + before * t10)
            of.append(before)
        fwd[at] = of
        after, back = 1.0, [1.0]
        for x in reversed(odds[1:]):
            right = x * after
            after = (t10 + t11 * right) / (t00 + t01 * right)
            back.append(after)
        bwd[at] = back[::-1]
        pairs += _pair_counts(fwd[at[:-1]], e[at[1:]] * bwd[at[1:]], t00, t01, t10, t11)
    for k in range(min(together, longest - 1) - 1, -1, -1):
        a, m = offset[k], active[k + 1]
        right = e[offset[k + 1] : offset[k + 1] + m] * bwd[offset[k + 1] : offset[k + 1] + m]
        bwd[a : a + m] = (t10 + t11 * right) / (t00 + t01 * right)
        pairs += _pair_counts(fwd[a : a + m], right, t00, t01, t10, t11)
    both = fwd * bwd
    marginal = np.empty(n)
    marginal[token] = both / (1 + both)
    return marginal, pairs


def _pair_counts(r, right, t00, t01, t10, t11) -> np.ndarray:
    """Expected transitions between tokens with forward odds ``r`` and the next
    ones with odds ``right``."""
    all_four = t00 + t01 * right + r * t10 + r * t11 * right
    return np.array(
        [
            [(t00 / all_four).sum(), (t01 * right / all_four).sum()],
            [(r * t10 / all_four).sum(), (r * t11 * right / all_four).sum()],
        ]
    )


def tokenize(text: str) -> tuple[list[str], list[int]]:
    """Tokens, and the lengths of the chains they make up: one chain a line, of
    any length."""
    tokens, lengths = [], []
    for line in text.split("\n"):
        found = TOKEN.findall(line)
        if found:
            tokens += found
            lengths.append(len(found))
    return tokens, lengths


#: Power by which a token's odds are sharpened before the odds of any toxic
#: token in the document are formed. Without it the many small marginals of a
#: long clean document would add up to a toxic one.
SHARPEN = 3


def aggregate(of_tokens: np.ndarray) -> tuple[float, float]:
    """Of a document, by the sharpened odds of its tokens: log odds that any is
    toxic, taking them as independent, and the log of the share of toxic ones.
    Both are smallest for a text without tokens."""
    p = np.clip(of_tokens, 1e-6, 1 - 1e-6)
    odds = (p / (1 - p)) ** SHARPEN
    some = float(np.clip(-np.expm1(-np.log1p(odds).sum()), 1e-12, 1 - 1e-6))
    share = float((odds / (1 + odds)).sum()) / (len(p) + 20) + 1e-5
    return np.log(some / (1 - some)), np.log(share) + 7


def toxic_features(docs: Iterable[Iterable[str]], toxic: np.ndarray) -> set[int]:
    """Features in at least 3 toxic documents that occur there far more often
    than chance (z above 4) and of whose documents at least 9 in 10 are toxic,
    weighted as if both classes were equally frequent."""
    with_it, with_toxic = Counter(), Counter()
    known: dict[str, list[int]] = {}
    for tokens, is_toxic in zip(docs, toxic):
        seen = set()
        for t in set(tokens):
            if t not in known:
                known[t] = features(t)
            seen.update(known[t])
        with_it.update(seen)
        if is_toxic:
            with_toxic.update(seen)
    rate = max(toxic.mean(), 1e-9)
    odds = rate / max(1 - rate, 1e-9)
    found = set()
    for f, k in with_toxic.items():
        n = with_it[f]
        z = (k - n * rate) / np.sqrt(max(n * rate * (1 - rate), 1e-9))
        share = k / (k + (n - k) * odds)
        if k >= 3 and share >= 0.9 and z > 4:
            found.add(f)
    return found


def train(texts: list[str], toxic: list[int], folds: list[int], epochs: int = 30, rate: float = 0.5) -> Crf:
    """Fit the field on fold 0 and its document calibration on fold 1.

    Full-batch AdaGrad on the log likelihood with a small quadratic penalty.
    Without toxic training documents the field scores every token as clean.
    """
    crf = Crf()
    texts, toxic, folds = [t or "" for t in texts], np.array(toxic, dtype=int), np.array(folds, dtype=int)
    fit = np.flatnonzero(folds == 0)
    forms: dict[str, int] = {}
    ids, length = [np.zeros(0, np.int32)], []
    for k in fit:  # numbers of the tokens' forms: the tokens themselves are not held
        tokens, lengths = tokenize(texts[k])
        ids.append(np.fromiter((forms.setdefault(t, len(forms)) for t in tokens), np.int32, len(tokens)))
        length += lengths
    names = list(forms)
    signs = toxic_features(([names[i] for i in np.unique(x)] for x in ids[1:]), toxic[fit]) if len(fit) else set()
    if not signs:
        return crf
    sign_of = np.array([any(f in signs for f in features(t)) for t in names])
    y = np.repeat(toxic[fit] > 0, [len(x) for x in ids[1:]])
    ids, length = np.concatenate(ids), np.array(length)
    y = (y & sign_of[ids]).astype(float)
    first = np.cumsum(length) - length
    form_of, buckets = [], []
    for t, k in forms.items():
        fs = [f & MASK for f in features(t)]
        form_of += [k] * len(fs)
        buckets += fs
    form_of, buckets = np.array(form_of), np.array(buckets)
    # Transitions observed in the labels.
    inside = np.ones(len(y), dtype=bool)
    inside[first] = False  # a chain's first token follows none
    at = np.flatnonzero(inside)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[at - 1].astype(int), y[at].astype(int)), 1)
    w, bias, trans = np.zeros(BUCKETS), crf.bias, np.zeros((2, 2))
    gw, gb, gt = np.full(BUCKETS, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(epochs):
        score = bias + np.bincount(form_of, weights=w[buckets], minlength=len(forms))
        p, pairs = forward_backward(score[ids], length, trans)
        by_form = np.bincount(ids, weights=y - p, minlength=len(forms))
        step = np.bincount(buckets, weights=by_form[form_of], minlength=BUCKETS) - 0.05 * w
        gw += step**2
        w += rate * step / np.sqrt(gw)
        db = float((y - p).sum())
        gb += db**2
        bias += rate * db / np.sqrt(gb)
        dt = seen_pairs - pairs - 0.05 * trans
        gt += dt**2
        trans += rate * dt / np.sqrt(gt)
    crf = Crf(w.astype(np.float32), bias, trans)
    rest = np.flatnonzero(folds != 0)
    of_docs = [aggregate(p) for _, p in marginals(crf, [texts[k] for k in rest])]
    crf.calibration = calibrate(np.array(of_docs).reshape(-1, 2), toxic[rest])
    return crf


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression of the label on the aggregates (Newton steps of
    bounded length, with a small penalty that pulls towards equal trust in them)."""
    prior = np.array([0.0, 0.5, 0.5])
    if not len(y) or y.min() == y.max():
        return tuple(prior)
    design = np.column_stack([np.ones(len(y)), x])
    b = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (y - p) - 1.0 * (b - prior)
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.eye(3)
        step = np.linalg.solve(hess, grad)
        b = b + step * min(1.0, 0.3 / max(np.abs(step).max(), 1e-12))
        b[1:] = np.maximum(b[1:], 0.0)  # more toxic tokens never lower the score
    return tuple(map(float, b))


def marginals(crf: Crf, texts: list[str]):
    """(text, marginals of its tokens) of each text. Many texts go through one
    forward-backward pass together (up to about 200,000 tokens)."""
    at = 0
    while at < len(texts):
        tokens, lengths, counts, begin = [], [], [], at
        while at < len(texts) and len(tokens) < 200_000:
            mine, chains = tokenize(texts[at])
            tokens += mine
            lengths += chains
            counts.append(len(mine))
            at += 1
        p, _ = forward_backward(crf.emissions(tokens), np.array(lengths, dtype=np.int64), crf.trans)
        ends = np.cumsum(counts)
        for k, (end, count) in enumerate(zip(ends, counts)):
            yield texts[begin + k], p[end - count : end]


def score_texts(crf: Crf, texts: list[str]) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """Score and offending spans (start and end in code points, marginal) of each text."""
    out = []
    for text, p in marginals(crf, texts):
        spans = []
        if len(p) and p.max() > 0.5:
            places = [m.span() for m in TOKEN.finditer(text)]
            spans = [(*places[k], float(p[k])) for k in np.flatnonzero(p > 0.5)]
        out.append((_calibrated(crf, p), spans))
    return out


def _calibrated(crf: Crf, of_tokens: np.ndarray) -> float:
    z = crf.calibration[0] + float(np.dot(crf.calibration[1:], aggregate(of_tokens)))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fold_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, mod 3: 1 is held out, 0 trains, 2 calibrates."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3).cast("int")


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list:
    """Text, label and fold of at most ``per_class`` labelled documents and
    TRAIN_CHARS characters of each class, none held out. The ids are chosen
    first, by a hash and from the labels alone, so the documents' texts are
    filtered by a broadcast of bounded size and not shuffled; then, in the order
    of the hash, those whose whole text still has room. A doc_id labelled twice
    counts as toxic if any row says so; of several documents with a chosen id one
    is taken."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("fold", fold_of()).where("fold <> 1")
    chosen = class_sample(known, "toxic", "doc_id", per_class).withColumnRenamed("doc_id", "_id")
    # At most 2 * per_class rows.
    mine = F.col("doc_id") == F.col("_id")
    taken = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(chosen), mine)
    sizes = taken.groupBy("doc_id", "toxic").agg(F.min(F.length("text")).alias("n"))
    rows = sizes.orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id").collect()
    room, fits = {0: TRAIN_CHARS, 1: TRAIN_CHARS}, []
    for r in rows:
        if r["n"] <= room[r["toxic"]]:
            room[r["toxic"]] -= r["n"]
            fits.append(r["doc_id"])
    if not fits:
        return []
    shortest = F.min_by("text", F.struct(F.length("text"), "text")).alias("text")
    grouped = taken.where(F.col("doc_id").isin(fits)).groupBy("doc_id")
    return grouped.agg(shortest, F.first("toxic").alias("toxic"), F.first("fold").alias("fold")).collect()


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Crf:
    rows = sorted(training_sample(docs, labels, per_class), key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], [r["toxic"] for r in rows], [0 if r["fold"] == 0 else 1 for r in rows])


SPANS = ArrayType(
    StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("p", DoubleType())])
)


def _tagged(docs: DataFrame, keep: list[str], crf: Crf) -> DataFrame:
    """The ``keep`` columns as one struct ``_row``, then score, predicted and spans.
    A text that is kept goes to Python once, inside the struct."""
    inside = keep.index("text") if "text" in keep else None
    weights = docs.sparkSession.sparkContext.broadcast((crf.emit, crf.bias, crf.trans, crf.calibration))
    text = [] if inside is not None else [F.coalesce(F.col("text"), F.lit("")).alias("_text")]
    kept = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_row"), *text)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    schema = StructType(
        [
            kept.schema["_row"],
            StructField("score", DoubleType()),
            StructField("predicted", IntegerType()),
            StructField("spans", SPANS),
        ]
    )

    def run(batches):
        model = Crf(*weights.value)
        for b in batches:
            texts = b.column(1) if inside is None else b.column(0).field(inside)
            scored = score_texts(model, [t or "" for t in texts.to_pylist()])
            score = np.array([s for s, _ in scored])
            spans = [[{"start": x, "end": y, "p": p} for x, y, p in found] for _, found in scored]
            arrays = [b.column(0), pa.array(score), pa.array((score >= PREDICT_AT).astype(np.int32)), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return kept.mapInArrow(run, schema)


def tag(docs: DataFrame, crf: Crf, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with ``score`` (0 to 1), ``predicted`` (1 if the
    score is at least PREDICT_AT) and ``spans``: start and end in code points
    and marginal of each offending token. NULL and empty texts have no tokens
    and get the score of a text with none offending. Whole texts are scored;
    no other column is looked at."""
    return _tagged(docs, keep, crf).select("_row.*", "score", "predicted", "spans")


def drop_toxic(docs: DataFrame, crf: Crf) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return _tagged(docs, docs.columns, crf).where("predicted = 0").select("_row.*")
