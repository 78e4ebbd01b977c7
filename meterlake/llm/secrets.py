"""Secret scan: fixed patterns, and a character convolutional network on top of them.

The patterns give the base findings.  Every run of the characters that keys are made of
is a candidate; candidates that touch a base finding are the labelled findings, all
others are clean.  A small network reads a candidate with its surroundings: character
embeddings, one convolution, pooled apart over what stands before, in and after the
candidate, one hidden layer.  Labelled findings are also shown with the
surroundings of a clean candidate, so that the value itself must tell.  It learns from
all different candidates in rounds: blocks of them (a hash decides) go on from the same
state, each in one task, and their states are averaged.  Scores are calibrated on the
held-out quarter, all of it; a score of one half passes, or less if the held-out
recall would fall below a bound, apart for short and long candidates.  A candidate that passes and touches no
base finding is added as a ``learned`` span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import materialise

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
KINDS = ("assign", "access", "hex", "learned")

# Characters of a candidate at least; those at most that count as a short one.
LEAST_CHARS, SHORT_CHARS = 12, 23
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST_CHARS)
# Characters read before, in (a longer candidate is read in several pieces) and after it.
BEFORE, BODY, AFTER = 24, 48, 8
WINDOW = BEFORE + BODY + AFTER
# Different windows of a block; rounds are as many as EPOCHS.  A window is in all rounds
# of few windows, in one at least: in so many that LEARNED windows are shown in all.
BLOCK, LEARNED = 48_000, 96_000
# Findings are repeated, with other surroundings, up to this share of the clean windows.
MARKED_SHARE = 0.1
# Logits are counted in steps of one over this; states are added in steps of one over the second.
STEPS, PARTS = 256, 1 << 36
# Share of the held-out findings that the thresholds must keep.
RECALL = 0.98
EMBEDDING, TAPS, FILTERS, HIDDEN, CODES = 8, 5, 24, 16, 129
EPOCHS, BATCH, RATE, SEED = 8, 128, 0.01, 11
# Windows scored at once: bounds a task's memory.
SCORED = 2048
_LEFT, _RIGHT = BEFORE - TAPS // 2, BEFORE + BODY - TAPS // 2  # where the middle of the taps enters and leaves the body


def look(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Base findings (start, number of the kind, end), sorted, and candidates (start, end)."""
    found, candidates = [], []
    for run in CANDIDATE.finditer(text):
        start, end = run.span()
        candidates.append((start, end))
        # both patterns are made of a candidate's characters and longer than the least one
        if end - start >= ACCESS_CHARS:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, start, end) if m.end() - m.start() >= ACCESS_CHARS]
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, start, end) if m.end() - m.start() >= HEX_CHARS]
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    return sorted(found), candidates


def touched(candidates: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each candidate shares a character with a base finding."""
    if not found:
        return [False] * len(candidates)
    starts = np.array([f[0] for f in found])
    reach = np.maximum.accumulate(np.array([f[2] for f in found]))
    before = np.searchsorted(starts, [end for _, end in candidates], side="left") - 1  # the last that starts before the end
    return [bool(k >= 0 and reach[k] > start) for k, (start, _) in zip(before.tolist(), candidates)]


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate in pieces of ``BODY`` characters, each between the same surroundings."""
    before = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0")
    after = text[end:end + AFTER].ljust(AFTER, "\0")
    return [before + text[at:min(at + BODY, end)].ljust(BODY, "\0") + after for at in range(start, end, BODY)]


def coded(texts: list[str]) -> np.ndarray:
    """Windows as rows of character codes; everything beyond ASCII is one code."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, WINDOW)
    return np.minimum(codes, CODES - 1).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weights of the network, the calibration (slope, offset) and the thresholds of
    short and long candidates, as calibrated probabilities."""
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    offset: float = 0.0
    short: float = 0.5
    long: float = 0.5

    def logits(self, codes: np.ndarray) -> np.ndarray:
        w = self.weights
        # the convolution of an embedded character is a row of a table
        table = np.einsum("ve,tef->tvf", w["embed"], w["taps"]).astype(np.float32)
        out = np.empty(len(codes))
        for at in range(0, len(codes), SCORED):
            part = codes[at:at + SCORED]
            width = WINDOW - TAPS + 1
            conv = table[0][part[:, :width]]
            for t in range(1, TAPS):
                conv += table[t][part[:, t:t + width]]
            conv = np.maximum(conv + w["bias"].astype(np.float32), 0)
            out[at:at + SCORED] = _head(w, _pooled(conv))[0]
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.offset, -40, 40)))

    def threshold(self, size: int) -> float:
        return self.short if size <= SHORT_CHARS else self.long


def _pooled(conv: np.ndarray) -> np.ndarray:
    body = conv[:, _LEFT:_RIGHT]
    return np.concatenate([conv[:, :_LEFT].max(axis=1), body.max(axis=1), body.mean(axis=1), conv[:, _RIGHT:].max(axis=1)], axis=1)


def _head(w: dict, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(pooled @ w["dense"] + w["dense_bias"], 0)
    return hidden @ w["out"] + w["out_bias"], hidden


def _gradients(w: dict, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted logistic loss, by back-propagation."""
    n, width = len(codes), WINDOW - TAPS + 1
    embedded = w["embed"][codes]
    columns = np.concatenate([embedded[:, t:t + width] for t in range(TAPS)], axis=2)
    flat = w["taps"].reshape(TAPS * EMBEDDING, FILTERS)
    before = columns @ flat + w["bias"]
    conv = np.maximum(before, 0)
    pooled = _pooled(conv)
    logits, hidden = _head(w, pooled)
    error = weight * (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels)
    d_hidden = np.outer(error, w["out"]) * (hidden > 0)
    d_pooled = d_hidden @ w["dense"].T
    d_conv = np.zeros_like(conv)
    rows, filters = np.arange(n)[:, None], np.arange(FILTERS)[None, :]
    for k, (a, b) in ((0, (0, _LEFT)), (1, (_LEFT, _RIGHT)), (3, (_RIGHT, width))):
        at = a + conv[:, a:b].argmax(axis=1)
        d_conv[rows, at, filters] += d_pooled[:, k * FILTERS:(k + 1) * FILTERS]
    d_conv[:, _LEFT:_RIGHT] += d_pooled[:, None, 2 * FILTERS:3 * FILTERS] / (_RIGHT - _LEFT)
    d_conv *= before > 0
    d_columns = d_conv @ flat.T
    d_embed = np.zeros_like(w["embed"])
    for t in range(TAPS):
        part = d_columns[:, :, t * EMBEDDING:(t + 1) * EMBEDDING].reshape(-1, EMBEDDING)
        at = codes[:, t:t + width].ravel()
        for e in range(EMBEDDING):
            d_embed[:, e] += np.bincount(at, weights=part[:, e], minlength=CODES)
    return {"embed": d_embed, "taps": np.tensordot(columns, d_conv, axes=([0, 1], [0, 1])).reshape(TAPS, EMBEDDING, FILTERS),
            "bias": d_conv.sum(axis=(0, 1)), "dense": pooled.T @ d_hidden, "dense_bias": d_hidden.sum(axis=0), "out": hidden.T @ error, "out_bias": error.sum()}


def start() -> dict[str, np.ndarray]:
    """Weights to begin with."""
    rng = np.random.default_rng(SEED)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, (2 / max(1, int(np.prod(shape[:-1])))) ** 0.5, shape)

    return {"embed": rng.normal(0, 0.5, (CODES, EMBEDDING)), "taps": normal(TAPS, EMBEDDING, FILTERS), "bias": np.zeros(FILTERS),
            "dense": normal(4 * FILTERS, HIDDEN), "dense_bias": np.zeros(HIDDEN), "out": normal(HIDDEN, 1)[:, 0], "out_bias": np.zeros(())}


def fit(codes: np.ndarray, labels: np.ndarray, state: list[dict], steps: int, seed: int) -> list[dict]:
    """Go on from a state (weights and both moments of Adam, after ``steps`` steps) over
    the windows once; both classes weigh alike."""
    w, m, v = ({k: np.array(x) for k, x in part.items()} for part in state)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    order = np.random.default_rng(seed).permutation(len(codes))
    for at in range(0, len(order), BATCH):
        some, steps = order[at:at + BATCH], steps + 1
        for k, g in _gradients(w, codes[some], labels[some], weight[some] / len(some)).items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g ** 2
            w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** steps)) / (np.sqrt(v[k] / (1 - 0.999 ** steps)) + 1e-8)
    return [w, m, v]


def flat(state: list[dict]) -> np.ndarray:
    return np.concatenate([np.ravel(part[k]) for part in state for k in sorted(part)])


def unflat(values: np.ndarray) -> list[dict]:
    shapes, out, at = start(), [{}, {}, {}], 0
    for part in out:
        for k in sorted(shapes):
            part[k] = values[at:at + shapes[k].size].reshape(shapes[k].shape)
            at += shapes[k].size
    return out


def calibrate(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the logits log-odds (Newton steps, a little ridge)."""
    x, slope = np.stack([logits, np.ones(len(logits))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ slope, -40, 40)))
        gradient = x.T @ (weight * (p - labels)) + 1e-3 * (slope - [1.0, 0.0])
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        slope = slope - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return float(max(slope[0], 1e-3)), float(slope[1])


def _windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All different windows of each batch of texts: label, hash, window."""
    for part in parts:
        own: dict[tuple[int, int], str] = {}
        for text in part.column("text").to_pylist():
            if text:
                found, candidates = look(text)
                for (at, end), label in zip(candidates, touched(candidates, found)):
                    for window in windows(text, at, end):
                        own[int(label), xxhash.xxh64_intdigest(window.encode("utf-8", "surrogatepass")) >> 1] = window
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.int32()), pa.array([h for _, h in own], pa.int64()),
                                          pa.array(list(own.values()), pa.string())], names=["label", "h", "win"])


def _shown(rows: pd.DataFrame, repeat: bool) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of a block's windows: the clean ones, the findings and these with
    the surroundings of clean ones, repeated if they are to be learned."""
    rows = rows.sort_values(["label", "h"])
    clean, marked = (rows["win"][rows["label"] == k].tolist() for k in (0, 1))
    if repeat and marked:
        marked = marked * max(1, int(MARKED_SHARE * len(clean) / len(marked)))
    rng, bare = np.random.default_rng(SEED), []
    if clean:
        other = [clean[i] for i in rng.integers(0, len(clean), len(marked))]
        bare = [o[:BEFORE] + w[BEFORE:BEFORE + BODY] + o[-AFTER:] for o, w in zip(other, marked)]
    return coded(clean + marked + bare), np.array([0.0] * len(clean) + [1.0] * (len(marked) + len(bare)))


def _block(now: np.ndarray, steps: int, seed: int):
    """What a block's windows change of a state, times their number."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        codes, labels = _shown(rows, True)
        moved = flat(fit(codes, labels, unflat(now), steps, seed)) - now
        n = len(rows)
        # the last rows tell the windows and the steps
        return pd.DataFrame({"at": np.arange(len(moved) + 2), "n": np.concatenate([np.rint(moved * n * PARTS), [n, -(-len(codes) // BATCH) * n]])})
    return run


def _learn(rounds: list[DataFrame]) -> dict[str, np.ndarray]:
    """Weights after the rounds: each block's windows change a copy of the state, which is
    averaged by windows (whole numbers are added, so that their order doesn't matter)."""
    zero = {k: np.zeros_like(x) for k, x in start().items()}
    state, steps = [start(), zero, zero], 0
    for seed, part in enumerate(rounds):
        now = flat(state)

        sums = part.groupBy("block").applyInPandas(_block(now, steps, seed), "at int, n double").groupBy("at").agg(
            F.sum(F.col("n").cast("decimal(38,0)")).cast("double").alias("n")).orderBy("at").collect()
        if sums:
            total = np.array([r.n for r in sums])
            state, steps = unflat(now + total[:-2] / PARTS / total[-2]), steps + int(round(total[-1] / total[-2]))
            state[2] = {k: np.maximum(x, 0) for k, x in state[2].items()}
    return state[0]


def train(docs: DataFrame, text_column: str = "text", recall: float = RECALL) -> Model | None:
    """Learn from the candidates of all texts.  States and counts reach the driver, no
    windows.  None without at least 8 different windows of either class."""
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    found = materialise(texts.mapInArrow(_windows, "label int, h long, win string").dropDuplicates(["label", "h"]), "secret-windows")
    number = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    if min(number.get(k, 0) for k in (0, 1)) < 8:
        return None
    n = sum(number.values())
    blocks, shown = -(-n // BLOCK), max(1, min(EPOCHS, LEARNED // n))
    # other bits of the hash tell the block, the first round and the held-out quarter
    found = found.select("label", "h", "win", (F.col("h") % blocks).alias("block"), (F.shiftright("h", 20) % EPOCHS).alias("slot"),
                         (F.shiftright("h", 40) % 4 == 3).alias("held"))
    known = found.filter(~F.col("held"))
    w = _learn([known.filter((F.col("slot") + r) % EPOCHS < shown) for r in range(EPOCHS)])

    def scored(rows: pd.DataFrame) -> pd.DataFrame:
        codes, labels = _shown(rows, False)
        short = (codes[:, BEFORE:BEFORE + BODY] != 0).sum(axis=1) <= SHORT_CHARS
        return pd.DataFrame({"label": labels, "short": short, "step": np.floor(Model(w).logits(codes) * STEPS)})

    counts = found.filter("held").groupBy("block").applyInPandas(scored, "label double, short boolean, step double").groupBy(
        "label", "short", "step").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "short", "step").collect()
    truth, short, logits, times = (np.array([r[c] for r in counts]) for c in ("label", "short", "step", "n"))
    logits = logits / STEPS
    if not (truth == 1).any() or not (truth == 0).any():
        return None
    share = number[1] / n
    weight = times * np.where(truth == 1, share / times[truth == 1].sum(), (1 - share) / times[truth == 0].sum()) * times.sum()
    model = Model(w, *calibrate(logits, truth, weight))

    def cut(chosen: np.ndarray) -> float:
        """One half, or less where the recall needs it; with few findings, that of all."""
        own = (truth == 1) & chosen
        own = own if times[own].sum() >= 20 else truth == 1
        order = np.argsort(logits[own])
        before = np.cumsum(times[own][order])
        least = logits[own][order][np.searchsorted(before, int((1 - recall) * before[-1]), side="right")]
        return min(0.5, float(1 / (1 + np.exp(-np.clip(model.slope * least + model.offset, -40, 40)))))

    return Model(w, model.slope, model.offset, cut(short), cut(~short))


def _scan(model: Model | None):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [t or "" for t in part]
            seen = [look(t) for t in texts]
            added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            if model is not None:
                pending: list[tuple[int, int, int, int]] = []  # text, start, end, windows
                held: list[str] = []

                def settle() -> None:
                    if not held:
                        return
                    chance, at = model.probabilities(coded(held)), 0
                    for k, start, end, n in pending:
                        if chance[at:at + n].max() >= model.threshold(end - start):
                            added[k].append((start, KINDS.index("learned"), start + len(texts[k][start:end].rstrip("."))))
                        at += n
                    pending.clear()
                    held.clear()

                for k, (found, candidates) in enumerate(seen):
                    for (start, end), base in zip(candidates, touched(candidates, found)):
                        if not base:
                            own = windows(texts[k], start, end)
                            pending.append((k, start, end, len(own)))
                            held += own
                            if len(held) >= SCORED:
                                settle()
                settle()
            spans = [[{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in sorted(found + more)]
                     for (found, _), more in zip(seen, added)]
            yield pd.DataFrame({"spans": spans, "values": [[t[s["start"]:s["end"]] for s in own] for t, own in zip(texts, spans)]})
    return run


def scan(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``spans``: kind, start, end (code points, end
    exclusive) of all findings by start, then kind as listed, and ``values``: what they
    cover.  Columns of these names are replaced.

    Null texts count as empty and have no span; texts of any length are scanned whole;
    repeated rows give repeated results; an empty table gives an empty result.
    """
    of = "struct<spans:array<struct<kind:string,start:int,end:int>>,values:array<string>>"
    scanned = _scan(model)

    @F.pandas_udf(of)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from scanned(parts)

    plain = docs.drop("spans", "values")
    names = plain.columns
    return plain.select("*", found(F.col(text_column).cast("string")).alias("_found")).select(
        *[F.col(f"`{c}`") for c in names], F.col("_found.spans").alias("spans"), F.col("_found.values").alias("values"))


def find_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``scan`` with a network trained on the same texts."""
    return scan(docs, train(docs, text_column), text_column)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, joined by commas)."""
    base = F.filter("spans", lambda s: s["kind"] != "learned")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS[:3]]
    return found.select(id_column, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
