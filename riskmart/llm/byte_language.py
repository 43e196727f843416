"""Language of a text by a bidirectional gated recurrent network over its bytes.

The text's UTF-8 bytes are read in windows of ``WINDOW`` bytes, all of them, one behind the
other.  In each window one network reads forwards and one backwards (a reset and an update
gate each); from both states every position gets a probability for each language, and a
document's probabilities are the mean over its positions.  Gates and candidate use
x / (1 + |x|), which costs a fifth of a hyperbolic tangent.

The network is trained in numpy on the driver, by backpropagation through time over windows
of a bounded sample: of each of the ``LANGUAGES`` most frequent languages, about
``TRAIN_DOCUMENTS`` documents chosen by a hash of doc_id and text, and of each
``TRAIN_WINDOWS`` windows at places the hash chooses.  A sample of the same size is drawn
from any corpus; nothing else is sampled, and every byte of every text is read when
languages are predicted.

Only documents whose crc32(doc_id as text) mod 5 is not 0 and whose lang is not null are
learned from; the prediction sees the text alone.

Defined cases: a null text, or one without a letter, is ``und`` with a score of 0, and so is
every text where nothing could be learned; a null doc_id counts as held out; of equal
probabilities the first language by name wins; rows that repeat are each labelled; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import raw_texts

HIDDEN = 8
WINDOW = 128                    # bytes that are read from a fresh state
BLOCK = 2048                    # windows that advance together
LANGUAGES = 64                  # the most frequent ones are learned
TRAIN_DOCUMENTS = 600           # about so many of each language
TRAIN_WINDOWS, TRAIN_BYTES = 6, 64
STEPS, BATCH, RATE = 350, 96, 0.02
UNKNOWN = "und"


# -- the network ---------------------------------------------------------------------------------

@dataclass
class Network:
    """Weights of both directions (0 reads forwards, 1 backwards); gates: 0 update, 1 reset, 2 candidate."""

    languages: list[str]
    seen: np.ndarray = field(default=None)       # [gate, direction, byte, hidden]
    state: np.ndarray = field(default=None)      # [gate, direction, hidden, hidden]
    out: np.ndarray = field(default=None)        # [forward | backward hidden, language]
    bias: np.ndarray = field(default=None)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        return cls(languages, draw(3, 2, 256, hidden) * 0.3, draw(3, 2, hidden, hidden) * 0.4,
                   draw(2 * hidden, len(languages)) * 0.3, np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.seen, self.state, self.out, self.bias]

    def states(self, windows: np.ndarray, trace: list | None = None, found: np.ndarray | None = None,
               sizes: np.ndarray | None = None) -> np.ndarray:
        """States [position, window, forward | backward hidden] of ``windows`` [window, position].

        Where ``sizes`` is given, what fills up a window behind its size is not read.  ``found`` may
        be given to be written over; ``trace`` gets what the way back needs.
        """
        n, length = windows.shape
        hidden = self.state.shape[-1]
        if found is None:
            found = np.empty((length, n, 2 * hidden), np.float32)
        h = np.zeros((2, n, hidden), self.seen.dtype)
        x, g = (np.empty((3, 2, n, hidden), self.seen.dtype) for _ in range(2))
        size = np.empty_like(h)
        columns = windows.T.astype(np.intp)
        for t in range(length):
            for gate in range(3):
                for d, byte in enumerate((columns[t], columns[length - 1 - t])):
                    np.take(self.seen[gate, d], byte, axis=0, out=x[gate, d], mode="clip")
            np.matmul(h, self.state, out=g)
            for gate in (0, 1):                   # 1 + s(x), twice the share that passes
                s = x[gate]
                s += g[gate]
                np.abs(s, out=size)
                size += 1
                s /= size
                s += 1
            update, reset, candidate = x
            if trace is not None:
                trace.append((h, g[2].copy(), update.copy(), reset.copy()))
            reset *= g[2]
            reset *= 0.5
            candidate += reset
            np.abs(candidate, out=size)
            size += 1
            candidate /= size
            if trace is not None:
                trace[-1] += (candidate.copy(),)
            candidate -= h
            candidate *= update
            candidate *= 0.5
            h = h + candidate
            if sizes is not None:
                h[1] *= (sizes > length - 1 - t)[:, None]
            found[t, :, :hidden], found[length - 1 - t, :, hidden:] = h[0], h[1]
        return found

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """[language, position, window] of ``states`` [position, window, ...]."""
        p = self.out.T @ states.reshape(-1, states.shape[-1]).T
        p += self.bias[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p.reshape(-1, *states.shape[:2])

    def gradients(self, windows: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions and its slope in every weight, back through time."""
        trace: list = []
        states = self.states(windows, trace)
        length, n, _ = states.shape
        hidden = self.state.shape[-1]
        p = self.probabilities(states)
        rows = np.arange(n)
        loss = -float(np.log(p[truth, :, rows] + 1e-9).mean())
        p[truth, :, rows] -= 1
        p /= length * n
        flat = p.reshape(len(p), -1)
        d_out = (flat @ states.reshape(-1, 2 * hidden)).T
        d_states = (flat.T @ self.out.T).reshape(states.shape)
        d_state, d_x = np.zeros_like(self.state), np.empty((length, 3, 2, n, hidden), np.float32)
        dh = np.zeros((2, n, hidden), np.float32)
        back = self.state.swapaxes(-1, -2)
        for t in reversed(range(length)):
            h, g_c, update, reset, candidate = trace[t]
            dh[0] += d_states[t, :, :hidden]
            dh[1] += d_states[length - 1 - t, :, hidden:]
            dx = d_x[t]
            dx[2] = dh * update * 0.5 * (1 - np.abs(candidate)) ** 2
            dx[0] = dh * (candidate - h) * 0.5 * (1 - np.abs(update - 1)) ** 2
            dx[1] = dx[2] * g_c * 0.5 * (1 - np.abs(reset - 1)) ** 2
            dg = dx.copy()
            dg[2] *= reset * 0.5
            d_state += np.matmul(h.swapaxes(-1, -2), dg)
            dh = dh * (1 - update * 0.5) + np.matmul(dg, back).sum(axis=0)
        d_seen = np.zeros_like(self.seen)
        for d, read in enumerate((windows.T, windows.T[::-1])):
            for gate in range(3):
                np.add.at(d_seen[gate, d], read.reshape(-1), d_x[:, gate, d].reshape(-1, hidden))
        return loss, [d_seen, d_state, d_out, flat.sum(axis=1)]


def trained(languages: list[str], windows: np.ndarray, truth: np.ndarray, steps: int = STEPS, seed: int = 13) -> Network:
    """A network fitted to ``windows`` [window, position] of the given languages, by Adam steps on random batches."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, HIDDEN, rng)
    first, second = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    by_language = [np.flatnonzero(truth == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        # languages take turns, however many windows each has
        pick = np.array([rng.choice(by_language[k]) for k in rng.permutation(BATCH) % len(languages)])
        slopes = net.gradients(windows[pick], truth[pick])[1]
        size = np.sqrt(sum(float((s ** 2).sum()) for s in slopes))
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for w, s, m, v in zip(net.weights(), slopes, first, second):
            s = s * min(1, 1 / max(size, 1e-9))
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


# -- the sample ------------------------------------------------------------------------------------

def held_out():
    """Whether a document is kept from training: crc32 of its doc_id as text, mod 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _letters():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``TRAIN_WINDOWS`` windows of each text, at places its hash chooses; a short text is said again to fill one."""
    for batch in batches:
        rows = []
        for lang, key, text in zip(batch.column("lang").to_pylist(), batch.column("key").to_pylist(),
                                   raw_texts(batch.column("text"))):
            places = {0}
            if len(text) < TRAIN_BYTES:
                text = ((text + b" ") * TRAIN_BYTES)[:TRAIN_BYTES]
            elif len(text) > TRAIN_BYTES:
                rng = np.random.default_rng(key & 0x7FFFFFFFFFFFFFFF)
                places = set(rng.integers(0, len(text) - TRAIN_BYTES + 1, TRAIN_WINDOWS).tolist())
            rows += [(lang, key, at, text[at: at + TRAIN_BYTES]) for at in sorted(places)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))],
            ["lang", "key", "at", "bytes"])


def fitted(docs: DataFrame) -> Network | None:
    """The network of ``docs`` (doc_id, text, lang); None where nothing can be learned."""
    learnable = docs.where(~held_out() & F.col("lang").isNotNull() & _letters()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("key"))
    common = learnable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    shares = common.select(F.col("lang").alias("of_lang"), (F.lit(TRAIN_DOCUMENTS) / F.col("n")).alias("share"))
    drawn = learnable.join(F.broadcast(shares), F.col("lang") == F.col("of_lang")).where(     # at most LANGUAGES rows
        F.pmod("key", F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "key", "text")
    # twice the expected number of windows at most, whatever the corpus
    most = 2 * LANGUAGES * TRAIN_DOCUMENTS * TRAIN_WINDOWS
    rows = drawn.mapInArrow(_cut, "lang string, key long, at long, bytes binary").orderBy("key", "at", "lang").limit(
        most).collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    windows = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8).reshape(-1, TRAIN_BYTES)
    return trained(languages, windows, np.array([languages.index(r["lang"]) for r in rows]))


# -- documents ---------------------------------------------------------------------------------------

def _windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (windows, the text each is of, its length); every byte of every text is in one window."""
    data = np.frombuffer(b"".join(texts) + b" " * WINDOW, np.uint8)
    sizes = np.array([len(t) for t in texts])
    counts = -(-sizes // WINDOW)
    of = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(np.cumsum(sizes) - sizes, counts) + at * WINDOW
    length = np.minimum(sizes[of] - at * WINDOW, WINDOW)
    for k in range(0, len(of), BLOCK):
        n = length[k: k + BLOCK]
        read = data[start[k: k + BLOCK, None] + np.arange(WINDOW)]
        read[np.arange(WINDOW) >= n[:, None]] = 32
        yield read, of[k: k + BLOCK], n


def _batched(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows whose texts make some blocks together; a long text may be one part alone."""
    start, held, part = 0, 0, []
    for k, text in enumerate(raw_texts(texts)):
        if held > 4 * BLOCK * WINDOW:
            yield batch.slice(start, k - start), part
            start, held, part = k, 0, []
        part.append(text)
        held += len(text)
    if part:
        yield batch.slice(start), part


def _pooler(net: Network):
    def pooled(texts: list[bytes], found: np.ndarray) -> np.ndarray:
        """Mean probability of each language over the bytes of each text."""
        total = np.zeros((len(texts), len(net.languages)))
        for windows, of, n in _windows(texts):
            short = n.min() < WINDOW
            p = net.probabilities(net.states(windows, found=found[:, :len(windows)], sizes=n if short else None))
            if short:
                p *= np.arange(WINDOW)[:, None] < n
            np.add.at(total, of, p.sum(axis=1).T)
        return total / np.maximum([[len(t)] for t in texts], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.empty((WINDOW, BLOCK, 2 * net.state.shape[-1]), np.float32)
        for whole in batches:
            for batch, texts in _batched(whole, whole.column("text")):
                mean = pooled(texts, found)
                best = mean.argmax(axis=1)
                known = np.array([len(t) > 0 for t in texts])
                score = np.clip(mean[np.arange(len(texts)), best], 0, 1) * known
                lang = [net.languages[k] if b else UNKNOWN for k, b in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"])
    return run


def _readable(docs: DataFrame) -> DataFrame:
    """The texts that have a letter; others are empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.when(_letters(), F.col("text")).otherwise("").alias("text"))


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row."""
    rows = _readable(docs)
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_pooler(net), "doc_id long, held_out boolean, lang_pred string, score double")


def _runner(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, texts in _batched(whole, whole.column("text")):
                labels: list[list[np.ndarray]] = [[] for _ in texts]
                for windows, of, n in _windows(texts):
                    best = net.probabilities(net.states(windows, sizes=n)).argmax(axis=0).astype(np.uint8)
                    for k, (text, size) in enumerate(zip(of.tolist(), n.tolist())):
                        labels[text].append(best[:size, k])
                out = []
                for parts in labels:
                    found = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
                    cut = np.flatnonzero(np.diff(found.astype(np.int16), prepend=-1))
                    out.append([{"start": a, "end": b, "lang": net.languages[found[a]]}
                                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(found)])])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "runs"])
    return run


def labelled(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, runs) of each row: the most probable language at every byte, as runs (start, end, lang)."""
    return _readable(docs).drop("held_out").mapInArrow(
        _runner(net), "doc_id long, runs array<struct<start:long,end:long,lang:string>>")
