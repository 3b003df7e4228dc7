"""Secret scans: patterns, and a character convolutional network over all candidates.

Every run of token characters that mixes letters and digits is a candidate; the
network scores them all, each with the characters around it. It is trained, in numpy,
on labelled findings; its scores are calibrated by a logistic curve on findings it
was not trained on, and its threshold is the highest that keeps the recall on others.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

# The patterns that a secret is reported by without the network.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "model")
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

LEFT, INSIDE, RIGHT = 32, 48, 16
WIDTH = LEFT + INSIDE + RIGHT
RECALL = 0.95
EXAMPLES, EPOCHS, FILTERS, SPAN, EMBEDDED = 4000, 6, 24, 5, 12

_CODES = np.full(256, 69, np.uint8)
for _i, _c in enumerate(string.ascii_letters + string.digits):
    _CODES[ord(_c)] = _i
for _i, _c in enumerate("+/_=-"):
    _CODES[ord(_c)] = 62 + _i
_CODES[[9, 10, 13, 32]] = 67
_CODES[[34, 39, 58, 96]] = 68
_BLANK, _SYMBOLS = 70, 71


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, ordered by start and kind."""
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if re.search(r"[0-9]", m[0]) and re.search(r"[A-Za-z]", m[0])]


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters before, in (its two ends, if it is long) and after a candidate."""
    inside = text[start:end] if end - start <= INSIDE else text[start : start + INSIDE // 2] + text[end - INSIDE // 2 : end]
    parts = ((text[max(0, start - LEFT) : start].rjust(LEFT, "\0")), inside.ljust(INSIDE, "\0"), text[end : end + RIGHT].ljust(RIGHT, "\0"))
    raw = np.frombuffer("".join(parts).encode("latin-1", "replace"), np.uint8)
    return np.where(raw == 0, _BLANK, _CODES[raw]).astype(np.uint8)


@dataclass
class Network:
    """Embedding, one convolution with ReLU, maximum and mean over places, logistic output."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 0.5

    def forward(self, codes: np.ndarray):
        x = self.embedding[codes]
        places = WIDTH - SPAN + 1
        columns = np.lib.stride_tricks.sliding_window_view(x, SPAN, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), places, SPAN * EMBEDDED)
        active = np.maximum(columns @ self.filters + self.bias, 0)
        pooled = np.concatenate([active.max(axis=1), active[:, LEFT : LEFT + INSIDE].mean(axis=1)], axis=1)
        return columns, active, pooled, pooled @ self.out + self.out_bias

    def probability(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        logits = np.concatenate([self.forward(codes[i : i + 512])[3] for i in range(0, len(codes), 512)])
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -30, 30)))


def train(codes: np.ndarray, labels: np.ndarray, seed: int = 11, epochs: int = EPOCHS, recall: float = RECALL) -> Network:
    """Fit by Adam on three fifths of the findings, calibrate on a fourth, set the threshold on the last."""
    rng = np.random.default_rng(seed)
    fold = np.arange(len(labels)) // 2 % 5  # findings stand in pairs of both labels
    net = Network(rng.normal(0, 0.3, (_SYMBOLS, EMBEDDED)), rng.normal(0, 0.2, (SPAN * EMBEDDED, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), 0.0)
    names = ("embedding", "filters", "bias", "out", "out_bias")
    moment = {n: [np.zeros_like(getattr(net, n), float), np.zeros_like(getattr(net, n), float)] for n in names}
    x, y, step = codes[fold > 1], labels[fold > 1].astype(float), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            own = order[at : at + 64]
            columns, active, pooled, logit = net.forward(x[own])
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[own]) / len(own)
            back = error[:, None] * net.out
            grad_active = np.zeros_like(active)
            peak = active.argmax(axis=1)
            r, f = np.indices(peak.shape)
            grad_active[r, peak, f] = back[:, :FILTERS]
            grad_active[:, LEFT : LEFT + INSIDE] += back[:, None, FILTERS:] / active[:, LEFT : LEFT + INSIDE].shape[1]
            grad_active *= active > 0
            grad_columns = (grad_active @ net.filters.T).reshape(len(own), -1, SPAN, EMBEDDED)
            grad_embedding = np.zeros_like(net.embedding)
            for k in range(SPAN):
                np.add.at(grad_embedding, x[own][:, k : k + grad_columns.shape[1]], grad_columns[:, :, k])
            gradients = {"embedding": grad_embedding, "filters": np.tensordot(columns, grad_active, ((0, 1), (0, 1))), "bias": grad_active.sum(axis=(0, 1)), "out": pooled.T @ error, "out_bias": error.sum()}
            step += 1
            for n in names:
                m, v = moment[n]
                m[...] = 0.9 * m + 0.1 * gradients[n]
                v[...] = 0.999 * v + 0.001 * gradients[n] ** 2
                setattr(net, n, getattr(net, n) - 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))
    truth = labels[fold == 0].astype(float)
    logits = net.forward(codes[fold == 0])[3]
    a, b = 1.0, 0.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        a, b = a - 0.05 * ((p - truth) * logits).mean(), b - 0.5 * (p - truth).mean()
    net.slope, net.offset = a, b
    scores = np.sort(net.probability(codes[(fold == 1) & (labels > 0)]))
    net.threshold = float(scores[int((1 - recall) * len(scores))]) if len(scores) else 1.0
    return net


def labelled_findings(n: int = EXAMPLES, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Labelled findings, made by a seeded rule: credentials of many forms where credentials
    stand, and the ids, digests, paths, numbers and words that look like them."""
    rng = random.Random(seed)
    pick = lambda letters, low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    alnum, hexes, b64 = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    word = lambda: pick("aeioulnrstdhm", 2, 9)
    prose = lambda k: " ".join(word() for _ in range(k))
    keys = ("key", "access_key", "auth", "bearer", "pwd", "credential", "private_key", "client_secret", "token", "Authorization: Bearer", "pass", "apikey", "signature", "session")
    starts = ("sk_live_", "ghp_", "xoxb-", "xoxp-", "glpat-", "AIza", "npm_", "SG_", "")
    texts, labels = [], []
    for i in range(n):
        positive = i % 2 == 0
        if positive:
            value = rng.choice((lambda: rng.choice(starts) + pick(alnum, 20, 44), lambda: pick(b64, 24, 60) + "=" * rng.randint(0, 2), lambda: pick(hexes.upper(), 32, 40), lambda: "eyJ" + pick(alnum + "_-", 30, 90)))()
            before = rng.choice((f"{rng.choice(keys)} = ", f"{rng.choice(keys)}: ", f'"{rng.choice(keys)}":"', f"export {rng.choice(keys).upper()}=", f"--{rng.choice(keys)} ", f"my {rng.choice(keys)} is ", f"{word()}_{rng.choice(keys)}=", f"https://{word()}:"))
            after = "@" + word() if before.startswith("https") else rng.choice(('"', "'", " ", ";\n", "\n"))
        else:
            value = rng.choice((lambda: "_".join(word() for _ in range(4)) + str(rng.randint(1, 99)), lambda: "-".join(word() for _ in range(4)) + f"-{rng.randint(1, 2030)}", lambda: "/".join(word() for _ in range(4)) + f"/{rng.randint(1, 999)}", lambda: pick(hexes, 8, 8) + "-" + pick(hexes, 4, 4) + "-4" + pick(hexes, 3, 3) + "-" + pick(hexes, 12, 12), lambda: pick(hexes.upper(), 32, 40), lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}0000Z", lambda: word() + word() + str(rng.randint(10**6, 10**9)) + word(), lambda: "=" * rng.randint(14, 30) + str(rng.randint(1, 9)) + "a"))()
            before = rng.choice((prose(3) + " ", "see ", "commit ", "sha256: ", "http://", "version ", "id ", "file ", "checksum ", "\n"))
            after = rng.choice((" " + prose(2), ".", ",", "\n", ")"))
        text = prose(rng.randint(0, 5)) + " " + before
        found = candidates(text + value + after + prose(3))
        inside = [s for s in found if s[1] > len(text)] or [(len(text), len(text) + len(value))]
        texts.append(window(text + value + after + prose(3), *inside[0]))
        labels.append(positive)
    return np.stack(texts), np.array(labels)


def find(text: str, net: Network) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """The pattern spans, those with the network's spans that overlap none of them, and how many
    candidates the network holds for secrets, those under pattern spans included."""
    base = base_spans(text)
    every = candidates(text)
    if not every:
        return base, base, 0
    scores = net.probability(np.stack([window(text, *c) for c in every]))
    likely = [c for c, p in zip(every, scores) if p >= net.threshold]
    starts, ends = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    at = [bisect_left(starts, end) for _, end in likely]
    added = [(start, 3, end) for k, (start, end) in zip(at, likely) if not k or ends[k - 1] <= start]
    return base, sorted(base + added), len(likely)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text", net: Network | None = None) -> DataFrame:
    """The ``keep`` columns of every row, the number of spans of each pattern, ``n_model`` (candidates
    that the network holds for secrets, those under pattern spans too), ``base`` (pattern spans,
    kind:start:end by start, code points, end exclusive) and ``spans`` (all of them; the network's
    where they overlap no pattern's).

    Null and empty texts have no spans, texts of any length are scanned whole, repeated rows
    each give a row.
    """
    net = net or train(*labelled_findings())

    def run(texts):
        n, model, base, spans = ([], [], []), [], [], []
        for text in texts:
            own, every, likely = find(text or "", net)
            model.append(likely)
            for kind in range(3):
                n[kind].append(sum(s[1] == kind for s in own))
            base.append(joined(own))
            spans.append(joined(every))
        return [*n, model, base, spans]

    return map_texts(docs, keep, text_column, run, "n_assign long, n_access long, n_hex long, n_model long, base string, spans string")
