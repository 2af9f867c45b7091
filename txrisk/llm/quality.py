"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (512 bytes each, the whole text). Every passage
is encoded; a gated attention layer learned from document labels alone weighs
the passages; the weighted passage representation is scored.

    h_k = tanh(E x_k),  a = softmax(w . (tanh(V h_k) * sigmoid(U h_k))),
    score = sigmoid(c . sum_k a_k h_k + b)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal

PASSAGE = 512               # bytes of a passage
SAMPLE_DOCS = 6000          # labelled documents used for fitting, at most
SAMPLE_PASSAGES = 48_000    # passages of all of them; documents are taken whole or not at all
_HIDDEN, _GATE, _STEPS, _RATE = 16, 8, 400, 0.03
_CHUNK = 256 << 10          # bytes encoded at a time (a longer text by itself)
_COUNTED = 512              # passages whose bytes are counted at a time

_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.zeros(256, np.int32)                    # 0: control and the rest
for _group, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                                 b" ", b"\n", bytes(range(128, 192)), bytes(range(192, 256)),
                                 *(bytes([c]) for c in _PUNCT)), 1):
    _CLASS[list(_bytes)] = _group
_CLASSES = int(_CLASS.max()) + 1
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
FEATURES = _CLASSES + 6
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (one row a passage) and the number of passages a text.

    A null or empty text is one passage without content.
    """
    raw = [(t or "").encode() for t in texts]
    sizes = np.array([len(r) for r in raw])
    bags = np.maximum(1, -(-sizes // PASSAGE))
    first = bags.cumsum() - bags
    n = int(bags.sum())
    length = np.full(n, PASSAGE)
    length[first + bags - 1] = sizes - (bags - 1) * PASSAGE
    buf = np.frombuffer(b"".join(raw) + b" " * 8, np.uint8)
    body = buf[:int(sizes.sum())]
    x = np.zeros((n, FEATURES), np.float32)
    begins = length.cumsum() - length
    for k in range(0, n, _COUNTED):
        part = length[k:k + _COUNTED]
        of = np.repeat(np.arange(len(part), dtype=np.int32), part) * np.int32(_CLASSES)
        of += _CLASS[body[begins[k]:begins[k] + part.sum()]]
        counts = np.bincount(of, minlength=len(part) * _CLASSES).reshape(-1, _CLASSES)
        x[k:k + _COUNTED, :_CLASSES] = np.sqrt(counts / np.maximum(1, part)[:, None])
    # Words: runs without white space, cut where texts meet.
    solid = ~_SPACE[body]
    text_start = np.zeros(len(body) + 1, bool)
    text_start[np.concatenate([[0], sizes.cumsum()])] = True
    begin = solid & np.concatenate([[True], ~solid[:-1]]) | solid & text_start[:-1] if len(body) else solid
    end = solid & np.concatenate([~solid[1:], [True]]) | solid & text_start[1:] if len(body) else solid
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if len(starts):
        size = ends - starts
        head = np.zeros(len(starts), np.uint64)
        for k in range(8):
            head |= buf[np.minimum(starts + k, len(buf) - 1)].astype(np.uint64) << np.uint64(8 * k)
        head &= _KEEP[np.minimum(size, 8)]
        passage = np.searchsorted(begins, starts, side="right") - 1
        words = np.maximum(1, np.bincount(passage, minlength=n))
        for k, lag in enumerate((1, 2, 3)):
            same = np.zeros(len(starts))
            same[lag:] = (head[lag:] == head[:-lag]) & (size[lag:] == size[:-lag]) & (passage[lag:] == passage[:-lag])
            x[:, _CLASSES + k] = np.bincount(passage, same, minlength=n) / words
        x[:, _CLASSES + 3] = np.log1p(np.bincount(passage, size, minlength=n) / words)
        x[:, _CLASSES + 4] = np.bincount(passage, size == 1, minlength=n) / words
    x[:, _CLASSES + 5] = np.log1p(length) / 6
    return x, bags


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _forward(m: dict, x: np.ndarray, bags: np.ndarray):
    first = bags.cumsum() - bags
    z = (x - m["mean"]) / m["std"]
    h = np.tanh(z @ m["E"] + m["e"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    s = (t * g) @ m["w"]
    s = np.exp(s - np.repeat(np.maximum.reduceat(s, first), bags))
    a = s / np.repeat(np.add.reduceat(s, first), bags)
    bag = np.add.reduceat(h * a[:, None], first, axis=0)
    return z, h, t, g, a, bag, _sigmoid(bag @ m["c"] + m["b"])


_SHAPES = {"E": (FEATURES, _HIDDEN), "e": (_HIDDEN,), "V": (_HIDDEN, _GATE), "U": (_HIDDEN, _GATE),
           "w": (_GATE,), "c": (_HIDDEN,), "b": ()}
_DECAY = 1e-4               # on the matrices


def start_model(x: np.ndarray, seed: int = 7) -> dict:
    """Scaling of the features, random weights."""
    rng = np.random.default_rng(seed)
    m = {"mean": x.mean(axis=0), "std": x.std(axis=0) + 1e-3}
    for k, s in _SHAPES.items():
        s = (x.shape[1], *s[1:]) if k == "E" else s
        m[k] = rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) == 2 else np.zeros(s)
    m["c"], m["w"] = rng.normal(0, 0.3, _HIDDEN), rng.normal(0, 0.3, _GATE)
    return m


def gradients(m: dict, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict:
    """Of the mean log loss plus half the decay times the matrices' squares."""
    first = bags.cumsum() - bags
    z, h, t, g, a, bag, p = _forward(m, x, bags)
    d = (p - y) / len(y)
    dbag = np.repeat(np.outer(d, m["c"]), bags, axis=0)
    da = (h * dbag).sum(axis=1)
    ds = a * (da - np.repeat(np.add.reduceat(a * da, first), bags))
    dt, dg = np.outer(ds, m["w"]) * g * (1 - t * t), np.outer(ds, m["w"]) * t * g * (1 - g)
    dh = (dbag * a[:, None] + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
    grad = {"E": z.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds,
            "c": bag.T @ d, "b": d.sum()}
    return {k: v + _DECAY * m[k] if k in "EVU" else v for k, v in grad.items()}


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Fit all layers on document labels ``y`` (log loss, Adam, full batch)."""
    m = start_model(x, seed)
    moment = {k: (0.0, 0.0) for k in _SHAPES}
    for step in range(1, _STEPS + 1):
        for k, v in gradients(m, x, bags, y).items():
            one, two = moment[k]
            moment[k] = one, two = 0.9 * one + 0.1 * v, 0.999 * two + 0.001 * v * v
            m[k] = m[k] - _RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    return m


def scores(m: dict | None, texts: list[str | None]) -> np.ndarray:
    """Scores of whole texts, encoded in bounded chunks."""
    if m is None:
        return np.full(len(texts), 0.5)
    out, part, size = [], [], 0
    for t in [*texts, None]:
        part.append(t)
        size += len(t or "")
        if size > _CHUNK:
            out.append(_forward(m, *encode(part))[-1])
            part, size = [], 0
    if part:
        out.append(_forward(m, *encode(part))[-1])
    return np.concatenate(out)[:len(texts)]


def _slices(b: pa.RecordBatch, at: int, rows: int = 200):
    """Parts of a batch of at most ``rows`` rows and about _CHUNK bytes of text
    (one longer text is a part by itself)."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy())])
    k = 0
    while k < b.num_rows:
        end = int(np.searchsorted(sizes, sizes[k] + _CHUNK, side="right")) - 1
        end = min(max(end, k + 1), k + rows, b.num_rows)
        yield b.slice(k, end - k)
        k = end


def _sampled(it):
    """(id, y, text) rows -> (id, y, features of all passages)."""
    for b in it:
        for part in _slices(b, b.schema.names.index("text")):
            x, bags = encode(part.column("text").to_pylist())
            ends = bags.cumsum()
            rows = [x[e - n:e].tobytes() for n, e in zip(bags, ends)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(rows, pa.binary())],
                                             names=["id", "y", "x"])


def held_out(id_col: str):
    """crc32(id as text) mod 5 = 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """Fit on at most ``sample_docs`` labelled documents (lowest id hashes), all
    passages of each; a document that would take the sample over
    ``SAMPLE_PASSAGES`` passages is left out whole.

    Only labels with crc32(id as text) mod 5 other than 0 are read; null ids
    and labels are left out; repeated labels of an id are averaged; of rows
    that repeat an id one is used. Without a usable label the model is None.
    """
    text = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).cast("string").alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    chosen = usable.join(text.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    sizes = text.join(F.broadcast(chosen), "id").groupBy("id", "y") \
        .agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"), F.min(F.xxhash64("id")).alias("at")).collect()
    taken, total = [], 0
    for r in sorted(sizes, key=lambda r: (r["at"], r["id"])):           # at most sample_docs rows
        passages = max(1, -(-r["size"] // PASSAGE))
        if total + passages <= SAMPLE_PASSAGES:
            taken.append((r["id"], r["y"]))
            total += passages
    if not taken:
        return None
    taken = docs.sparkSession.createDataFrame(taken, "id string, y double")
    bags = text.join(F.broadcast(taken), "id").select("id", "y", "text") \
        .mapInArrow(frugal(_sampled), "id string, y double, x binary").groupBy("id", "y").agg(F.min("x").alias("x"))
    rows = sorted(bags.toArrow().to_pylist(), key=lambda r: r["id"])   # at most SAMPLE_PASSAGES passages
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(np.concatenate(x).astype(np.float64), np.array([len(v) for v in x]), np.array([r["y"] for r in rows]))


def score_documents(docs: DataFrame, model: dict | None, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a double column ``to`` appended (replacing one so named).

    Null and empty texts get the score of a passage without content; without a
    model every score is 0.5. Rows are scored one by one, so repeated rows get
    equal scores and an empty table stays empty.
    """
    out = docs.drop(to)
    at, names = out.columns.index(text_col), [*out.columns, to]

    def run(it):
        for b in it:
            for part in _slices(b, at, 1000):
                s = pa.array(scores(model, part.column(at).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, s], names=names)

    return out.mapInArrow(frugal(run), T.StructType([*out.schema.fields, T.StructField(to, T.DoubleType())]))
