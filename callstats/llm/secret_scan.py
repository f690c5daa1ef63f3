"""Secret scan: base patterns, and a character convolutional network over candidates.

The base patterns' findings always count. Beyond them a generator proposes
every token that could be a secret, and a small convolutional network in numpy
reads the token with its surroundings. It is trained on labelled findings, its
scores are calibrated, and the threshold of each candidate kind is the largest
that keeps a set recall on held-out findings.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from callstats.llm.common import map_texts

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: Candidates: whole runs of key characters with a letter and a digit, and
#: whatever follows a word for a credential.
RUN = re.compile(r"[A-Za-z0-9+/_=~-]{12,}")
KEYED = re.compile(
    r"\b(?:pwd|pass(?:phrase)?|auth(?:orization)?|bearer|credentials?|(?:private|access|secret|client)[_\x20-]?key)"
    r"[\x20\"':=]{1,5}([^\s\"']{8,})",
    re.IGNORECASE | re.ASCII,
)

LEFT, BODY, RIGHT = 24, 40, 8
WIDTH = LEFT + BODY + RIGHT
#: Codes of a window: printable ASCII, other characters, beyond the text.
CODES = 97
EMBED, KERNEL, FILTERS = 8, 5, 24

#: Bounds of the training sample: documents, and characters of all of them
#: together (texts are taken whole, of any length, while there is room).
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 8_000_000
RECALL = 0.98


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base findings, leftmost and not
    overlapping within a kind, by start and then kind. A match that fails its
    length test is dropped, and the search goes on after it."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of tokens that may be secrets: kind "run" or "keyed"."""
    out = []
    for m in RUN.finditer(text):
        t = m[0]
        if not (t.isalpha() or t.isdigit()) and re.search("[0-9]", t) and re.search("[A-Za-z]", t):
            out.append((m.start(), m.end(), "run"))
    out += [(m.start(1), m.end(1), "keyed") for m in KEYED.finditer(text)]
    return sorted(set(out))


def windows(text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and in-token marks of the windows over a token and its
    surroundings. A token longer than BODY gets several overlapping windows."""
    codes, marks = [], []
    for at in range(start, max(start + 1, end - BODY + 1 + BODY // 2), BODY // 2):
        a, b = at - LEFT, at + BODY + RIGHT
        piece = text[max(a, 0) : b]
        raw = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
        row = np.full(WIDTH, 96, dtype=np.uint8)
        row[max(-a, 0) : max(-a, 0) + len(raw)] = np.where((raw >= 32) & (raw < 127), raw - 32, 95)
        codes.append(row)
        place = np.arange(a, b)
        marks.append((place >= start) & (place < end))
    return np.array(codes), np.array(marks)


@dataclass
class Network:
    """Embedding, one convolution with ReLU, pooled over the token (largest and
    mean) and over its surroundings (largest), and a logistic output.
    ``platt`` calibrates the output; ``thresholds`` per candidate kind."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    platt: tuple[float, float] = (1.0, 0.0)
    thresholds: tuple[tuple[str, float], ...] = (("run", 0.5), ("keyed", 0.5))

    @staticmethod
    def new(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        fan = KERNEL * (EMBED + 1)
        return Network(
            rng.normal(0, 0.5, (CODES, EMBED)),
            rng.normal(0, np.sqrt(2 / fan), (fan, FILTERS)),
            np.zeros(FILTERS),
            np.append(rng.normal(0, 0.1, 3 * FILTERS), 0.0),
        )

    def forward(self, codes: np.ndarray, marks: np.ndarray):
        n, steps = len(codes), WIDTH - KERNEL + 1
        x = np.concatenate([self.embed[codes], marks[:, :, None].astype(float)], axis=2)
        cols = np.concatenate([x[:, k : k + steps] for k in range(KERNEL)], axis=2)
        h = np.maximum(cols @ self.conv + self.bias, 0)
        inside = marks[:, KERNEL // 2 : KERNEL // 2 + steps][:, :, None]
        token, around = h * inside, h * ~inside
        size = np.maximum(inside.sum(axis=1), 1)
        pooled = np.concatenate([token.max(axis=1), token.sum(axis=1) / size, around.max(axis=1), np.ones((n, 1))], axis=1)
        return pooled @ self.out, (x, cols, h, inside, token, around, size, pooled)

    def step(self, codes, marks, y, moments: dict, t: int, rate: float) -> float:
        """One Adam step on the logistic loss; returns the loss."""
        z, (x, cols, h, inside, token, around, size, pooled) = self.forward(codes, marks)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        dz = (p - y) / len(y)
        dpool = dz[:, None] * self.out[None, :-1]
        dmax, dmean, daround = np.split(dpool, 3, axis=1)
        dh = inside * (dmean / size)[:, None, :]
        rows, filters = np.arange(len(y))[:, None], np.arange(FILTERS)[None, :]
        np.add.at(dh, (rows, token.argmax(axis=1), filters), dmax)
        np.add.at(dh, (rows, around.argmax(axis=1), filters), daround)
        dh *= h > 0
        dcols = dh @ self.conv.T
        steps, wide = dh.shape[1], EMBED + 1
        dx = np.zeros_like(x)
        for k in range(KERNEL):
            dx[:, k : k + steps] += dcols[:, :, k * wide : (k + 1) * wide]
        dembed = np.zeros_like(self.embed)
        np.add.at(dembed, codes, dx[:, :, :EMBED])
        grads = {
            "out": pooled.T @ dz,
            "conv": np.tensordot(cols, dh, axes=([0, 1], [0, 1])),
            "bias": dh.sum(axis=(0, 1)),
            "embed": dembed,
        }
        for name, g in grads.items():
            m, v = moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            moments[name] = (m, v)
            w = getattr(self, name)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return float(-np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))

    def scores(self, found: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probability of each (text, start, end): that of its
        highest window."""
        if not found:
            return np.zeros(0)
        parts = [windows(*f) for f in found]
        counts = [len(c) for c, _ in parts]
        codes, marks = (np.concatenate(x) for x in zip(*parts))
        z = np.concatenate([self.forward(codes[k : k + 512], marks[k : k + 512])[0] for k in range(0, len(codes), 512)])
        top = np.maximum.reduceat(z, np.cumsum(counts) - counts)
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30)))


def train(findings: Iterable[tuple[str, int, int, str, int]], epochs: int = 12, recall: float = RECALL) -> Network:
    """Network fitted to labelled findings (text, start, end, kind, 0 or 1).

    Every fifth finding is held out of the fit; the calibration and each kind's
    threshold (the largest that finds at least ``recall`` of the kind's
    secrets) come from those.
    """
    net, findings = Network.new(), list(findings)
    fit = [f for k, f in enumerate(findings) if k % 5]
    rest = [f for k, f in enumerate(findings) if k % 5 == 0]
    if not fit:
        return net
    firsts = [windows(text, s, min(e, s + BODY)) for text, s, e, _, _ in fit]
    codes, marks = np.array([c[0] for c, _ in firsts]), np.array([m[0] for _, m in firsts])
    y = np.array([f[4] for f in fit], dtype=float)
    rng, moments, t = np.random.default_rng(11), {}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), 128):
            part = order[k : k + 128]
            t += 1
            net.step(codes[part], marks[part], y[part], moments, t, 0.01 if epoch < epochs // 2 else 0.003)
    truth = np.array([f[4] for f in rest])
    raw = net.scores([f[:3] for f in rest])
    net.platt = _platt(np.log(raw / (1 - raw)), truth)
    score = net.scores([f[:3] for f in rest])
    thresholds = []
    for kind in ("run", "keyed"):
        hits = np.sort(score[[f[3] == kind and f[4] == 1 for f in rest]])
        low = hits[int((1 - recall) * len(hits))] if len(hits) else 0.5
        thresholds.append((kind, float(low)))
    net.thresholds = tuple(thresholds)
    return net


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression of y on x, with a weak prior."""
    b = np.array([1.0, 0.0])
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (y - p) - (b - [1.0, 0.0])
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        b = b + np.linalg.solve(hess, grad)
    return float(b[0]), float(b[1])


def labelled_findings(texts: list[str], seed: int = 3, per_kind: int = 250) -> list[tuple[str, int, int, str, int]]:
    """Labelled findings in the given texts.

    Secrets are the base findings, the candidates around them, and generated
    credentials of several layouts set into passages of the texts. The rest are
    generated look-alikes (identifiers, versions, addresses, long words) and those
    of the texts' other candidates whose letters spell words of several texts.
    Any other candidate may be a secret and has no label.
    """
    rng = random.Random(seed)
    digits, letters, both = string.digits, string.ascii_letters, string.ascii_letters + string.digits

    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))

    def word() -> str:
        return rng.choice(words) if words else some(string.ascii_lowercase, 3, 9)

    words = [w for t in texts[:200] for w in re.findall(r"[A-Za-z]{3,}", t)[:50]]
    hexes = string.digits + "abcdef"
    secret_layouts = {
        "run": [
            lambda: some(both, 24, 44),
            lambda: some(both + "+/", 40, 60) + "=",
            lambda: rng.choice(["ghp_", "xoxb-", "sk_live_", "glpat-"]) + some(both, 20, 36),
            lambda: "eyJ" + some(both + "_-", 40, 80),
            lambda: some(digits + "ABCDEF", 32, 40),
            # A base finding inside a longer credential.
            lambda: rng.choice(["sk_live_", "key-", "", "v1="]) + some(hexes, 16, 28) + some(both, 6, 16),
        ],
        "keyed": [
            lambda: some(both + "!#%&*", 10, 24),
            lambda: some(both, 16, 40),
            lambda: some(hexes, 12, 15),
        ],
    }
    other_layouts = {
        "run": [
            lambda: "-".join(word() for _ in range(3)) + "-" + some(digits, 1, 4),
            lambda: word() + word() + some(digits, 1, 4),
            lambda: f"{word()}_{word()}_{some(digits, 1, 6)}",
            lambda: f"20{some(digits, 2, 2)}-{some(digits, 2, 2)}-{some(digits, 2, 2)}T{some(digits, 6, 6)}Z",
            lambda: "/" + "/".join(word() for _ in range(3)) + "/" + some(digits, 1, 5),
            lambda: "ORDER-" + some(digits, 8, 14),
            lambda: word() * 2 + "=" + some(digits, 1, 3),
        ],
        "keyed": [
            lambda: word() + word() + word(),
            lambda: "https://" + word() + ".example.com/" + word(),
            lambda: word() + "," + word() + ".",
            lambda: "****" * rng.randint(2, 5),
        ],
    }
    keys = ["pwd", "auth", "bearer", "passphrase", "access key", "client_key", "credential"]
    found = []

    def passage() -> tuple[str, str]:
        t = rng.choice(texts) if texts else " ".join(word() for _ in range(30))
        at = rng.randint(0, len(t))
        at = t.rfind(" ", 0, at) + 1
        return t[max(0, at - 60) : at], t[at : at + 40]

    for label, layouts in ((1, secret_layouts), (0, other_layouts)):
        for kind, makers in layouts.items():
            for make in makers:
                for _ in range(per_kind):
                    before, after = passage()
                    token = make()
                    lead = rng.choice(keys) + rng.choice([" ", ": ", "=", ' = "']) if kind == "keyed" else rng.choice(["", "", '"', "("])
                    text = before + lead + token + rng.choice([" ", '" ', ". "]) + after
                    start = len(before) + len(lead)
                    found.append((text, start, start + len(token), kind, label))
    spelled = Counter(w for t in texts for w in {w.lower() for w in re.findall(r"[A-Za-z]+", t)})
    for t in texts:
        base = base_spans(t)
        found += [(t, s, e, "run", 1) for s, _, e in base[:4]]
        for s, e, kind in candidates(t)[:8]:
            if any(a < e and s < b for a, _, b in base):
                found.append((t, s, e, kind, 1))
            elif all(spelled[w.lower()] > 2 for w in re.findall(r"[A-Za-z]+", t[s:e])):
                found.append((t, s, e, kind, 0))
    rng.shuffle(found)
    return found


def sample_texts(docs: DataFrame, bound: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[str]:
    """Texts of at most ``bound`` documents, chosen by a hash of doc_id; in its
    order a text is taken if it still has room in ``chars`` characters."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(bound).select(F.col("doc_id").alias("_id"))
    taken = docs.select("doc_id", "text").where(F.length("text") > 0).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    sizes = taken.groupBy("doc_id").agg(F.min(F.length("text")).alias("n"))
    fits = []
    for r in sizes.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").collect():
        if r["n"] <= chars:
            chars -= r["n"]
            fits.append(r["doc_id"])
    if not fits:
        return []
    shortest = F.min_by("text", F.struct(F.length("text"), "text")).alias("text")
    rows = taken.where(F.col("doc_id").isin(fits)).groupBy("doc_id").agg(shortest).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def all_spans(net: Network, texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Base spans and accepted candidates (start, kind number, end) of each text."""
    base = [base_spans(t) for t in texts]
    found, owner, kinds = [], [], []
    for k, t in enumerate(texts):
        for s, e, kind in candidates(t):
            found.append((t, s, e))
            owner.append(k)
            kinds.append(kind)
    limit = dict(net.thresholds)
    extra: list[set] = [set() for _ in texts]
    for k, f, kind, p in zip(owner, found, kinds, net.scores(found)):
        if p >= limit[kind]:
            extra[k].add((f[1], 3, f[2]))
    # What is a base finding already is not told twice.
    return [(b, sorted(x - {(s, 3, e) for s, _, e in b})) for b, x in zip(base, extra)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(docs: DataFrame, net: Network, keep: list[str]) -> DataFrame:
    """``keep`` columns, counts of base findings (n_assign, n_access, n_hex),
    base_sha256 and spans (kind:start:end in code points, by start and kind,
    base findings and accepted candidates; kind cnn for the latter).

    Every candidate is scored, also those in and around base findings, and reported
    if accepted, but where it is just a base finding. NULL texts count as empty; a
    text without findings has counts 0, the hash of the empty string and empty
    spans. Whole texts of any length are scanned; equal rows get equal results;
    an empty table gives no rows. Only ``keep`` (any names but those of the
    results) and ``text`` are read.
    """
    parts = docs.sparkSession.sparkContext.broadcast(
        (net.embed, net.conv, net.bias, net.out, net.platt, net.thresholds)
    )

    def find(texts: list[str]) -> list[pa.Array]:
        rows = all_spans(Network(*parts.value), texts)
        counts = [pa.array([sum(s[1] == k for s in base) for base, _ in rows], pa.int64()) for k in range(3)]
        hashes = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
        return [*counts, pa.array(hashes, pa.string()), pa.array([joined(b + x) for b, x in rows], pa.string())]

    fields = [StructField(n, LongType()) for n in ("n_assign", "n_access", "n_hex")]
    fields += [StructField(n, StringType()) for n in ("base_sha256", "spans")]
    return map_texts(docs, keep, "text", find, fields)
