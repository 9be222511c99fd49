"""Toxicity by a convolutional text classifier.

Words are white-space separated, in lower case and without marks at their ends.  A word's
embedding is the sum of two rows of a table, found by two hashes, so that words that share
one row stay apart.  Filters of several widths run over the embeddings; each filter's
largest response in the whole text, of whatever length, goes into a logistic output.

Every labelled document that is not held out takes part, of whatever length.  The first
coordinate of the table starts from how far a row's words favour toxic documents, counted
over all of them, the rest at random.  The documents are dealt by a hash of doc_id to units of
about `sample`; Adam with class weights trains a network on each unit in its task, and of the
networks the mean is taken, for a row of the table over the units that moved it.  The sums are of
whole numbers, so their order does not matter.  A fifth of the documents is kept from training
and gives each language its threshold, the one of best F1.  Languages are told by their
commonest words in the text itself.  Scores are shifted so that 0.5 is the threshold.
Neither labels nor lang, source or doc_id enter a score.

Null and empty texts get the score of an empty text.  Labels that are null, or of unknown
documents, are not used; without both classes in what is trained on every score is the share of
toxic labels (0 without any).  Repeated rows are scored each; of the rows of one doc_id
the one of the smallest hashed words is trained on.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.llm.shared import bucket_count, free_name, staged, tidy
from formfold.llm.tokens import slices
from formfold.sources.staging import remove

#: Very common words by language.
COMMON = {
    "de": "der die das und den von zu mit sich des auf ist im dem nicht ein eine",
    "en": "the of and to in is that for it was on with as are by be this",
    "es": "el los las que y en del se por con para una su al lo como",
    "fr": "le les des et du une est dans qui pour sur pas au ce il par plus",
}
LANGUAGES = ["", *sorted(COMMON)]
STRIPPED = "".join(chr(c) for c in range(0x250) if not chr(c).isalnum()) + "‘’“”„…–—"


def word_of(piece: str) -> str:
    return piece.lower().strip(STRIPPED)


class Words:
    """CRC-32 of the words of a text; remembers at most `remembered` pieces."""

    def __init__(self, remembered: int = 200_000):
        self.known: dict[str, int] = {}
        self.remembered = remembered

    def __call__(self, text: str) -> np.ndarray:
        known, pieces = self.known, text.split()
        if len(known) > self.remembered:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = zlib.crc32(word_of(p).encode("utf-8"))
        return np.array([known[p] for p in pieces], np.uint32)


LISTS = [np.array(sorted(zlib.crc32(w.encode()) for w in COMMON[name].split()), np.uint32) for name in LANGUAGES[1:]]


LISTED = np.unique(np.concatenate(LISTS))
MEMBERS = np.stack([np.isin(LISTED, x) for x in LISTS], axis=1).astype(np.int64)
#: Whether a listed word ends in these 16 bits: most words are told apart by them.
ENDS = np.isin(np.arange(1 << 16), LISTED & 0xFFFF)


def language(words: np.ndarray) -> int:
    """Place in LANGUAGES; 0 where no common word occurs."""
    near = words[ENDS[words & 0xFFFF]]
    at = np.minimum(np.searchsorted(LISTED, near), len(LISTED) - 1)
    counts = np.bincount(at[LISTED[at] == near], minlength=len(LISTED)) @ MEMBERS
    return 1 + int(np.argmax(counts)) if counts.max() else 0


@dataclass
class Network:
    rows: int = 1 << 16
    dims: int = 8
    filters: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    seed: int = 11
    constant: float | None = None
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    shifts: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def start(self, favour: np.ndarray) -> None:
        rng = np.random.default_rng(self.seed)
        table = rng.normal(0, 0.02, (self.rows + 1, self.dims)).astype(np.float32)
        table[:-1, 0] = favour
        table[-1] = 0  # what stands behind a text's end
        self.weights = {"table": table, "out": rng.normal(0, 0.1, self.filters * len(self.widths)).astype(np.float32) + 0.5,
                        "base": np.zeros(1, np.float32)}
        for w in self.widths:
            self.weights[f"f{w}"] = rng.normal(0, 0.2, (w, self.dims, self.filters)).astype(np.float32)
            self.weights[f"f{w}"][:, 0, :] += 1.0 / w
            self.weights[f"b{w}"] = np.zeros(self.filters, np.float32)

    def places(self, words: np.ndarray) -> np.ndarray:
        """The two rows of each word."""
        return np.stack([words % self.rows, (words.astype(np.uint64) * 0x9E3779B97F4A7C15 >> np.uint64(40)) % self.rows]).astype(np.int64)

    def joined(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows (2, words) of all texts, each followed by enough empty places; where texts begin."""
        tail = max(self.widths)
        sizes = np.array([len(t) + tail for t in texts])
        starts = np.cumsum(sizes) - sizes
        out = np.full((2, int(sizes.sum())), self.rows, np.int64)
        if texts:
            inside = np.ones(out.shape[1], bool)
            for k in range(tail):
                inside[starts + sizes - 1 - k] = False
            out[:, inside] = self.places(np.concatenate(texts))
        return out, starts

    def responses(self, at: np.ndarray, starts: np.ndarray, table: dict | None = None):
        """By width, what each filter gives at each place; nothing where it would reach the next text."""
        total = at.shape[1]
        stops = np.append(starts[1:], total)
        for w in self.widths:
            z = np.zeros((total, self.filters), np.float32)
            for j in range(w):
                part = (table[w, j][at[0, j:]] + table[w, j][at[1, j:]] if table is not None else
                        (self.weights["table"][at[0, j:]] + self.weights["table"][at[1, j:]]) @ self.weights[f"f{w}"][j])
                z[:total - j] += part
            z += self.weights[f"b{w}"]
            for j in range(1, w):
                z[stops - j] = -np.inf
            yield w, z

    def logits(self, texts: list[np.ndarray], table: dict | None = None) -> np.ndarray:
        at, starts = self.joined(texts)
        pooled = [np.maximum(np.maximum.reduceat(z, starts, axis=0), 0) for _, z in self.responses(at, starts, table)]
        return np.concatenate(pooled, axis=1).astype(np.float64) @ self.weights["out"] + float(self.weights["base"][0])

    def projected(self) -> dict:
        return {(w, j): self.weights["table"] @ self.weights[f"f{w}"][j] for w in self.widths for j in range(w)}

    def favour(self, seen: np.ndarray, hits: np.ndarray, share: float) -> np.ndarray:
        """How far the documents of each row, and the toxic ones of them, are from the toxic share."""
        usual = seen * share
        return np.tanh((hits - usual) / np.sqrt(usual + 1) / 6).astype(np.float32)

    def train(self, texts: list[np.ndarray], toxic: np.ndarray, share: float, rounds: int = 4, batch: int = 64,
              rate: float = 0.01) -> None:
        """On from the weights; share: of toxic documents, by which the classes are balanced."""
        balance = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
        rng = np.random.default_rng(self.seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(texts))
            for s in range(0, len(order), batch):
                some = order[s:s + batch]
                at, starts = self.joined([texts[i] for i in some])
                stops = [*starts[1:].tolist(), at.shape[1]]
                pooled, peaks = [], []
                for _, z in self.responses(at, starts):
                    peak = np.stack([a + z[a:b].argmax(0) for a, b in zip(starts.tolist(), stops)])
                    peaks.append(peak)
                    pooled.append(np.maximum(z[peak, np.arange(self.filters)], 0))
                x = np.concatenate(pooled, axis=1)
                p = 1 / (1 + np.exp(-(x @ self.weights["out"] + self.weights["base"][0])))
                g = ((p - toxic[some]) * balance[some] / len(some)).astype(np.float32)
                grads = {"out": x.T @ g, "base": np.array([g.sum()], np.float32)}
                touched, moves = [], []
                for n, w in enumerate(self.widths):
                    cols = slice(n * self.filters, (n + 1) * self.filters)
                    back = (g[:, None] * self.weights["out"][cols]) * (pooled[n] > 0)
                    grads[f"b{w}"] = back.sum(0)
                    grads[f"f{w}"] = np.zeros_like(self.weights[f"f{w}"])
                    for j in range(w):
                        rows = at[:, np.minimum(peaks[n] + j, at.shape[1] - 1)]
                        e = self.weights["table"][rows[0]] + self.weights["table"][rows[1]]
                        grads[f"f{w}"][j] = np.einsum("nfd,nf->df", e, back)
                        move = back[:, :, None] * self.weights[f"f{w}"][j].T[None]
                        for r in rows:
                            touched.append(r.reshape(-1))
                            moves.append(move.reshape(-1, self.dims))
                rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                dense = np.zeros((len(rows), self.dims), np.float32)
                np.add.at(dense, inverse, np.concatenate(moves))
                keep = rows < self.rows
                step += 1
                for k, grad, part in [("table", dense[keep], rows[keep]), *[(k, v, slice(None)) for k, v in grads.items()]]:
                    first[k][part] = 0.9 * first[k][part] + 0.1 * grad
                    second[k][part] = 0.999 * second[k][part] + 0.001 * grad ** 2
                    m, v = first[k][part] / (1 - 0.9 ** step), second[k][part] / (1 - 0.999 ** step)
                    self.weights[k][part] -= rate * m / (np.sqrt(v) + 1e-6)

    def packed(self) -> np.ndarray:
        """All weights as rows of `dims` numbers: the table, then the others with zeros at their end."""
        flat = np.concatenate([self.weights[k].reshape(-1) for k in sorted(self.weights) if k != "table"])
        return np.concatenate([self.weights["table"], np.pad(flat, (0, -len(flat) % self.dims)).reshape(-1, self.dims)])

    def unpack(self, rows: np.ndarray) -> None:
        rows = rows.astype(np.float32)
        self.weights["table"], flat = rows[:self.rows + 1].copy(), rows[self.rows + 1:].reshape(-1)
        for k in sorted(self.weights):
            if k != "table":
                v = self.weights[k]
                self.weights[k], flat = flat[:v.size].reshape(v.shape).copy(), flat[v.size:]


def best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """Midway between the two neighbours that part at the best F1; `best_cuts` finds it for any number."""
    order = np.argsort(-logits, kind="stable")
    right = np.cumsum(toxic[order])
    f1 = 2 * right / (np.arange(1, len(order) + 1) + max(1, toxic.sum()))
    i = int(f1.argmax())
    return float((logits[order[i]] + logits[order[min(i + 1, len(order) - 1)]]) / 2)


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the CRC-32 of doc_id as text; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Units of whole documents: `words` (little-endian unsigned 32-bit) of all of them one after the
#: other, `sizes` in words; `apart`: kept from training.
UNITS = pa.schema([("ids", pa.list_(pa.int64())), ("toxic", pa.list_(pa.int32())), ("apart", pa.list_(pa.bool_())),
                   ("sizes", pa.list_(pa.int64())), ("words", pa.binary())])
UNIT_BYTES = 64 << 20
#: Moves of weights are summed as whole multiples of this.
STEP = 2.0 ** -45


def dealt_rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["part", "id", "toxic", "words"])


def unit_row(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    ids, toxic, words = zip(*held)
    apart = [zlib.crc32(f"calibrate {i}".encode()) % 5 == 0 for i in ids]
    values = [list(ids), list(toxic), apart, [len(w) // 4 for w in words], b"".join(words)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, UNITS)], schema=UNITS)


def opened(batches):
    """(ids, toxic, apart, texts) of each unit."""
    for b in batches:
        for i in range(b.num_rows):
            ids, toxic, apart, sizes = [np.array(b.column(n)[i].as_py()) for n in ("ids", "toxic", "apart", "sizes")]
            words = np.frombuffer(b.column("words")[i].as_py(), np.uint32)
            yield ids, toxic.astype(np.int64), apart.astype(bool), np.split(words, np.cumsum(sizes)[:-1])


def units_of(docs: DataFrame, labels: DataFrame, unit: int) -> DataFrame:
    """The labelled documents that are not held out, one of each id, dealt to units."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")).where(
        F.col("_toxic").isin(0, 1) & ~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    parts = bucket_count(marked.count(), unit)
    # always by merge, whatever the size of the labels: rows arrive by id
    rows = docs.select("doc_id", "text").join(marked.hint("merge"), F.col("doc_id") == F.col("_id"))

    def hashed(batches):
        words, held = Words(), None
        out: list[tuple] = []
        for b in batches:
            for part, i, toxic, text in zip(*[c.to_pylist() for c in b.columns]):
                row = (part, i, toxic, words(text or "").tobytes())
                if held and held[:2] == row[:2]:  # copies of an id are one row already here
                    held = min(held, row)
                    continue
                if held:
                    out.append(held)
                held = row
            if out:
                yield dealt_rows(out)
                out = []
        if held:
            yield dealt_rows([held])

    def gather(table: pa.Table):
        held, size, last = [], 0, None
        for i, toxic, words in sorted(zip(*[table.column(n).to_pylist() for n in ("id", "toxic", "words")])):
            if i == last:  # of the rows of one id the smallest words
                continue
            if held and size + len(words) > UNIT_BYTES:
                yield unit_row(held)
                held, size = [], 0
            held.append((i, toxic, words))
            size, last = size + len(words), i
        yield unit_row(held)

    def gathered(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(gather(table)))

    typed = rows.select(F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int").alias("part"), F.col("_id").cast("long").alias("id"),
                        F.col("_toxic").cast("int").alias("toxic"), "text")
    dealt = typed.mapInArrow(tidy(hashed), "part int, id long, toxic int, words binary").repartition(parts, "part")
    return dealt.groupBy("part").applyInArrow(
        gathered, "ids array<bigint>, toxic array<int>, apart array<boolean>, sizes array<bigint>, words binary")


def counted(units: DataFrame, network: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents and toxic ones by row of the table, of those to train on; and (documents, toxic ones)
    of those to train on and of those apart."""
    def count(batches):
        seen, hits = np.zeros(network.rows + 2, np.int64), np.zeros(network.rows + 2, np.int64)
        for _, toxic, apart, texts in opened(batches):
            for t, y, a in zip(texts, toxic, apart):
                rows = [network.rows + 1] if a else [*np.unique(network.places(t)), network.rows]
                seen[rows] += 1
                hits[rows] += y
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at]), pa.array(hits[at])],
                                         names=["place", "seen", "hits"])

    got = units.select("ids", "toxic", "apart", "sizes", "words").mapInArrow(tidy(count), "place int, seen long, hits long").groupBy(
        "place").agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits")).toArrow()
    counts = np.zeros((2, network.rows + 2), np.int64)
    counts[:, got["place"].to_numpy()] = [got["seen"].to_numpy(), got["hits"].to_numpy()]
    return counts[0, :network.rows], counts[1, :network.rows], counts[:, network.rows:].T


def averaged(units: DataFrame, network: Network, share: float) -> None:
    """Train on each unit from the same start and take the mean of what comes out."""
    dims = [f"d{k}" for k in range(network.dims)]
    start = network.packed().astype(np.float64)

    def train(batches):
        for _, toxic, apart, texts in opened(batches):
            if apart.all():
                continue
            mine = Network(network.rows, network.dims, network.filters, network.widths, network.seed, weights={
                k: v.copy() for k, v in network.weights.items()})
            mine.train([t for t, a in zip(texts, apart) if not a], toxic[~apart], share)
            moved = mine.packed().astype(np.float64) - start
            at = np.flatnonzero(moved.any(axis=1))
            steps = np.rint(moved[at] / STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(c) for c in np.ascontiguousarray(steps.T)]],
                                             names=["place", *dims])

    got = units.mapInArrow(tidy(train), "place int, " + ", ".join(f"{d} long" for d in dims)).groupBy("place").agg(
        F.count("place").alias("n"), *[F.sum(d).alias(d) for d in dims]).toArrow()
    sums = np.stack([got[d].to_numpy() for d in dims], axis=1)
    start[got["place"].to_numpy()] += sums * STEP / got["n"].to_numpy()[:, None]
    network.unpack(start)


#: The logits of each language in falling order, by bins and within each bin; `k` of them stand up to
#: a row, `hits` of these are toxic, `below` is the next one.  The first row of best F1 wins.
CUTS = """
WITH bins AS (SELECT lang, bin, count(*) AS n, sum(toxic) AS t, max(logit) AS top FROM {rows} GROUP BY lang, bin),
above AS (
  SELECT lang, bin, (sum(n) OVER w) - n AS n, (sum(t) OVER w) - t AS t, lead(top) OVER w AS below,
         sum(n) OVER (PARTITION BY lang) AS whole, sum(t) OVER (PARTITION BY lang) AS toxic
  FROM bins WINDOW w AS (PARTITION BY lang ORDER BY bin DESC)),
ranked AS (
  SELECT r.lang, r.logit, a.whole, a.toxic, a.n + row_number() OVER w AS k,
         a.t + sum(r.toxic) OVER w AS hits,
         coalesce(lead(r.logit) OVER w, a.below, r.logit) AS below
  FROM {rows} r JOIN above a ON r.lang = a.lang AND r.bin = a.bin
  WINDOW w AS (PARTITION BY r.lang, r.bin ORDER BY r.logit DESC, r.id))
SELECT lang, max(whole) AS n, max(toxic) AS toxic,
       max_by((logit + below) / 2, struct(2 * hits / (k + greatest(1, toxic)) AS f1, -k AS first)) AS cut
FROM ranked GROUP BY lang
"""


def best_cuts(logits: DataFrame) -> dict:
    """Rows (n, toxic, cut) by language, with all languages together as -1, of (lang, id, logit, toxic)."""
    bins = F.floor(F.greatest(F.lit(-32.0), F.least(F.lit(32.0), "logit")) * 64).alias("bin")
    rows = logits.select(F.explode(F.array(F.col("lang"), F.lit(-1))).alias("lang"), "id", "logit", "toxic", bins)
    return {r.lang: r for r in logits.sparkSession.sql(CUTS, rows=rows).collect()}


def calibrate(units: DataFrame, network: Network, whole: bool) -> None:
    """The logit of best F1 of each language; of all texts where a language has too few."""
    def logits(batches):
        table = network.projected()
        for ids, toxic, apart, texts in opened(batches):
            some = [i for i in range(len(ids)) if whole or apart[i]]
            for first in range(0, len(some), 64):
                at = some[first:first + 64]
                found = network.logits([texts[i] for i in at], table)
                langs = [language(texts[i]) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.int32()), pa.array(ids[at], pa.int64()), pa.array(found), pa.array(toxic[at], pa.int32())],
                    names=["lang", "id", "logit", "toxic"])

    made, path = staged(units.mapInArrow(tidy(logits), "lang int, id long, logit double, toxic int"), "logits")
    cuts = best_cuts(made)
    remove(units.sparkSession, path)
    network.shifts = np.full(len(LANGUAGES), cuts[-1].cut)
    for lang, r in cuts.items():
        if lang >= 0 and r.toxic >= 10 and r.n - r.toxic >= 10:
            network.shifts[lang] = r.cut


def fit(docs: DataFrame, labels: DataFrame, sample: int = 5000) -> Network:
    """A network trained on all labelled rows that are not held out, about `sample` of them together
    in a task."""
    units, path = staged(units_of(docs, labels, sample), "labelled-words")
    network = Network()
    seen, hits, sizes = counted(units, network)
    (n, toxic), (apart, toxic_apart) = sizes.tolist()
    if not 0 < toxic < n:
        network.constant = (toxic + toxic_apart) / max(1, n + apart)
    else:
        network.start(network.favour(seen, hits, toxic / n))
        averaged(units, network, toxic / n)
        calibrate(units, network, not 0 < toxic_apart < apart)
    remove(docs.sparkSession, path)
    return network


def score_documents(docs: DataFrame, network: Network, into: str | None = None) -> DataFrame:
    """The rows with a struct of `score` and `predicted`, in a column named `into` (by default
    `toxicity`, with underscores until no column has that name); docs must have a text column."""
    names = docs.columns
    into = into or free_name(names, "toxicity")
    at, inner = names.index("text"), [f"c{i}" for i in range(len(names))]

    def score(batches):
        words = Words()
        table = network.projected() if network.constant is None else None
        for b in batches:
            for first, some in slices(b.column(at).to_pylist()):
                part = b.slice(first, len(some))
                if table is None:
                    scores = np.full(len(some), network.constant)
                else:
                    hashed = [words(t) for t in some]
                    shift = network.shifts[[language(t) for t in hashed]]
                    scores = 1 / (1 + np.exp(-np.clip(network.logits(hashed, table) - shift, -500, 500)))
                made = pa.StructArray.from_arrays([pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                                  names=["score", "predicted"])
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*inner, "made"])

    typed = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(inner, docs.schema))
    return docs.toDF(*inner).mapInArrow(tidy(score), f"{typed}, made struct<score:double,predicted:int>").toDF(*names, into)
