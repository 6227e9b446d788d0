"""Language identification by a bidirectional gated recurrent network over bytes.

Two recurrent layers of ``HIDDEN`` units read the UTF-8 bytes of a text forwards and backwards; from
both states a softmax labels every byte position with a language. A document's
probabilities are the mean over all of its positions. The recurrence is that of a GRU with the cheap
squashing x / (1 + |x|) in place of tanh and the logistic function:

    z, r = gates(x[t] + U h),  n = squash(y[t] + C (r * h)),  h = h + z * (n - h)

The network is trained in numpy by backpropagation through time, with Adam, on windows of at
most ``PER_LANGUAGE`` documents of each language: the bounded sample. Documents are chosen by a hash of
id and text among those offered for training, so reruns agree. Languages are the labels seen in training; they are few, and
one row of each goes through the driver.

Whole texts are labelled, in chunks of ``CHUNK`` bytes with fresh states, many chunks side by side.
A null text, or one without a letter, gets ``und`` with score 0; so does everything if
nothing could be learned. Repeated rows get equal answers; other columns are ignored by ``identify`` and passed on by
``of_known_language``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm import common

HIDDEN = 8
CHUNK = 128
PER_LANGUAGE = 500
WINDOWS = 4
WINDOW = 64
STEPS = 300
BATCH = 128
RATE = 0.02
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
#: A document is rejected where no language has this much of its probability.
LEAST_SCORE = 0.4
_SIDE = 2048


def squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Reader:
    """One direction: parameters X (input of each byte), U (gates), C (candidate)."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.n = hidden
        self.X = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.U = rng.normal(0, 0.3, (2 * hidden, hidden)).astype(np.float32)
        self.C = rng.normal(0, 0.3, (hidden, hidden)).astype(np.float32)

    def states(self, text: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte; text has a row per time and a column per sequence."""
        steps, width = text.shape
        n = self.n
        h = np.zeros((n, width), np.float32)
        out = np.empty((steps, n, width), np.float32)
        for t in range(steps):
            x = np.take(self.X, text[t], axis=1)
            s = self.U @ h
            s += x[: 2 * n]
            s /= np.abs(s) + 1
            gate = s * np.float32(0.5)
            gate += np.float32(0.5)
            z, r = gate[:n], gate[n:]
            q = r * h
            new = self.C @ q
            new += x[2 * n :]
            new /= np.abs(new) + 1
            if keep is not None:
                keep.append((h, s, z, r, q, new))
            h = h + z * (new - h)
            out[t] = h
        return out

    def backward(self, text: np.ndarray, keep: list, given: np.ndarray) -> list[np.ndarray]:
        """Gradients of X, U, C from those of the states."""
        n, (steps, width) = self.n, text.shape
        d_u, d_c = np.zeros_like(self.U), np.zeros_like(self.C)
        d_x = np.empty((steps, 3 * n, width), np.float32)
        dh = np.zeros((n, width), np.float32)
        for t in range(steps - 1, -1, -1):
            h, s, z, r, q, new = keep[t]
            dh = dh + given[t]
            d_new = dh * z * (1 - np.abs(new)) ** 2
            d_gate = np.concatenate((dh * (new - h), np.zeros_like(h)))
            d_q = self.C.T @ d_new
            d_gate[n:] = d_q * h
            d_gate *= 0.5 * (1 - np.abs(s)) ** 2
            d_c += d_new @ q.T
            d_u += d_gate @ h.T
            dh = dh * (1 - z) + d_q * r + self.U.T @ d_gate
            d_x[t, : 2 * n], d_x[t, 2 * n :] = d_gate, d_new
        which = np.zeros((256, steps * width), np.float32)
        which[text.reshape(-1), np.arange(steps * width)] = 1
        return [(which @ d_x.transpose(0, 2, 1).reshape(steps * width, 3 * n)).T, d_u, d_c]


class Network:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.languages = languages
        self.ahead, self.back = Reader(hidden, rng), Reader(hidden, rng)
        self.W = rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        self.b = np.zeros((len(languages), 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.X, self.ahead.U, self.ahead.C, self.back.X, self.back.U, self.back.C, self.W, self.b]

    def probabilities(self, text: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per time, language and sequence; and the states of both directions."""
        ahead = self.ahead.states(text, keep[0] if keep else None)
        back = self.back.states(text[::-1], keep[1] if keep else None)[::-1]
        both = np.concatenate((ahead, back), axis=1)
        scores = np.exp(self.W @ both + self.b)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, both

    def gradients(self, text: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        keep: tuple[list, list] = ([], [])
        p, both = self.probabilities(text, keep)
        steps, width = text.shape
        columns = np.arange(width)
        loss = -float(np.log(p[:, labels, columns] + 1e-9).mean())
        d = p.copy()
        d[:, labels, columns] -= 1
        d /= steps * width
        n = self.ahead.n
        d_both = self.W.T @ d
        d_w = np.einsum("tlb,thb->lh", d, both, optimize=True)
        d_b = d.sum(axis=(0, 2))[:, None]
        ahead = self.ahead.backward(text, keep[0], d_both[:, :n])
        back = self.back.backward(text[::-1], keep[1], d_both[::-1, n:])
        return loss, [*ahead, *back, d_w, d_b]


def train(windows: list[bytes], labels: list[int], languages: list[str], steps: int = STEPS, hidden: int = HIDDEN) -> Network:
    """Adam over random windows; each language is drawn equally often."""
    net = Network(languages, hidden)
    rng = np.random.Generator(np.random.PCG64(3))
    data = np.array([np.frombuffer(w.ljust(WINDOW), np.uint8)[:WINDOW] for w in windows], np.intp)
    of = [np.flatnonzero(np.array(labels) == k) for k in range(len(languages))]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        picked = np.arange(BATCH) % len(languages)
        rows = np.array([rng.choice(of[k]) for k in picked])
        _, grads = net.gradients(np.ascontiguousarray(data[rows].T), picked)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(net.parameters(), grads, first, second, strict=True):
            g = np.clip(g, -0.1, 0.1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def documents_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """A row per text: the mean probabilities over its positions (zeros for empty texts)."""
    data, bounds = common.buffers(column)
    total = np.zeros((len(bounds) - 1, len(net.languages)))
    lengths = np.diff(bounds)
    counts = -(-lengths // CHUNK)
    owner = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[:-1][owner] + within * CHUNK
    sizes = np.minimum(CHUNK, bounds[1:][owner] - starts)
    order = np.argsort(-sizes, kind="stable")  # chunks of one length together, so little is padded
    for at in range(0, len(order), _SIDE):
        part = order[at : at + _SIDE]
        steps = int(sizes[part[0]])
        places = starts[part] + np.arange(steps)[:, None]
        inside = np.arange(steps)[:, None] < sizes[part]
        # shorter chunks wait at the end behind spaces, which are not counted
        text = np.where(inside, data[np.minimum(places, len(data) - 1)], 32).astype(np.intp)
        p, _ = net.probabilities(text)
        p *= inside[:, None, :]
        np.add.at(total, owner[part], p.sum(axis=0, dtype=np.float64).T)
    return total / np.maximum(lengths, 1)[:, None]


def training_windows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame | None:
    """lang, h, windows of at most ``per_language`` texts of each language, copies once; None without labelled texts.

    Texts are chosen by their hash, about twice as many as wanted, before anything is shuffled, so that no text is; of
    these the first are taken.
    """
    known = docs.where("isnotnull(lang) and length(text) > 0").select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size")).collect()  # one row per language
    if not sizes:
        return None
    share = {r["lang"]: (20 + 2 * per_language) / r["size"] for r in sizes}
    shares = F.create_map(*[F.lit(x) for item in share.items() for x in item])
    starts = [F.lit(1) + F.pmod(F.xxhash64(F.lit(i), "h"), F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int") for i in range(WINDOWS)]
    cut = F.array(*[F.substring("text", s, F.lit(WINDOW)) for s in starts]).alias("windows")
    some = known.where(F.pmod("h", F.lit(1_000_003)) / 1_000_003 <= F.try_element_at(shares, F.col("lang"))).select("lang", "h", cut)
    once = some.groupBy("lang", "h").agg(F.min("windows").alias("windows"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "windows"))
    return once.withColumn("n", rank).where(F.col("n") <= per_language).drop("n")


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """The network from docs (text, lang); None where there is nothing to learn from."""
    picked = training_windows(docs, per_language)
    if picked is None:
        return None
    rows = picked.select("lang", "h", F.explode("windows").alias("window")).orderBy("lang", "h", "window").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    number = {name: k for k, name in enumerate(languages)}
    return train([r["window"].encode()[:WINDOW] for r in rows], [number[r["lang"]] for r in rows], languages)


def _predict(net: Network | None):
    def answers(texts: pa.Array, letters: list) -> tuple[list[str], list[float]]:
        if net is None:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        p = documents_probabilities(net, texts)
        best = p.argmax(axis=1)
        names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)]
        return names, [float(min(1.0, row[k])) if ok else 0.0 for row, k, ok in zip(p, best, letters, strict=True)]

    return answers


LETTER = r"\p{L}"


def _has_letter():
    return F.coalesce(F.col("text").rlike(LETTER), F.lit(False))


def trainable(docs: DataFrame) -> DataFrame:
    """Documents outside the held-out fold."""
    return docs.where(common.fold_of("doc_id", FOLDS) != HELD_OUT)


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score."""
    answers = _predict(net)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = answers(batch.column("text"), batch.column("letters").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=schema
            )

    held_out = F.coalesce(common.fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    texts = docs.select(F.col("doc_id").cast("bigint"), held_out, "text", _has_letter().alias("letters"))
    return texts.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def of_known_language(docs: DataFrame, net: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """The documents of a learned language, recognised with at least this score, with all their columns."""
    answers = _predict(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = answers(batch.column("text"), batch.column("letters").to_pylist())
            keep = [n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)]
            yield batch.drop_columns(["letters"]).filter(pa.array(keep, pa.bool_()))

    return common.map_rows(docs, run, letters=_has_letter())
