"""Language identification by interpolated Kneser-Ney character language models kept in sorted hash arrays.

Text is read as letters, lower-cased; every run of other characters is one space. Four-letter grams of all training documents are
counted per language in one pass (each task adds up its texts, a million letters at a time, before the shuffle). From these counts the
model of each language follows: the highest order uses counts, the lower orders use continuation counts (in how many different contexts
a gram is seen), and each order is discounted and interpolated with the next lower one.

The model is a written table in shards. A shard holds the grams whose two middle letters hash to it, with the log probabilities in all
languages side by side, in arrays sorted by hash: all that the orders four and three need to know about a gram lies in its shard.
Bigrams and letters, which the alphabets bound, go with every shard. A shard is built in one task and has about SHARD_BYTES, however
large the training table is; only discounts come to the driver, four numbers a language. A text's cross-entropy is the sum over the
shards of its grams' log probabilities: tasks load one shard after the other for each block of texts (and keep it if there is only one).
All grams of all languages are kept: none is pruned.

A text gets the language of the lowest cross-entropy per character. Rejection is calibrated by cross-fitting: two models are fitted on
one half of the training documents each (copies of a text in the same half) and judge the other half; each language's level is a high
quantile of these entropies, shrunk towards the entropy of random letters by SHRINK documents, so that every language has one and one
that little is known of rejects little. A text is rejected if it lies above the level of its language, short texts being allowed more, or
if it has no letters.

Defined results: null text or one without letters is `und` with score 0 and rejected. Ties go to the language first in code point
order. With no training text every document is `und`. Very long texts are judged whole, in blocks. Repeated rows get equal results; a
null doc_id counts as the text '' in the split. Extra columns are not read. The model's width grows with the distinct languages.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyline.llm.store import give_back, new_path, written
from tallyline.llm.words import U64, mix

ORDER = 4
UND = "und"
#: Rejection: the share of a language's training texts that must lie below its level, nats on top of that level, nats times the square
#: root of a text's length that chance may add, and the documents that the entropy of random letters counts for in each level.
CALIBRATED, MARGIN, SCATTER, SHRINK = 0.999, 0.7, 8.0, 20
#: Letters counted or judged at a time; bytes of a shard.
BLOCK, SHARD_BYTES = 1 << 20, 64 << 20
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point -> lower-case code point for letters, else 0; made once per process."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for low, high in ((0, 0xD800), (0xE000, 0x110000)):
            for c in range(low, high):
                char = chr(c)
                if char.isalpha():
                    table[c] = ord(char.lower()[0])
        _letters = table
    return _letters


def letter_codes(text: str) -> np.ndarray:
    """Letters as 16-bit codes with one 0 for each run of other characters, and a 0 at both ends; empty if there is no letter."""
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return np.zeros(0, U64)
    return _one_space(np.concatenate((np.zeros(1, U64), _packed(codes), np.zeros(1, U64))))


def grams(codes: np.ndarray) -> np.ndarray:
    """Runs of ORDER codes, packed in 64 bits; a shorter text gets leading spaces."""
    codes = np.concatenate((np.zeros(max(0, ORDER - len(codes)), U64), codes))
    n = len(codes) - ORDER + 1
    packed = np.zeros(n, U64)
    for k in range(ORDER):
        packed = (packed << U64(16)) | codes[k : k + n]
    return packed


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def gram_counts(training: DataFrame) -> DataFrame:
    """(fold, lang, gram, n) over all rows of (lang, text); copies of a text are in the same fold."""
    schema = pa.schema([("fold", pa.int32()), ("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list[np.ndarray]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (fold, lang), parts in held.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(gram), fold, np.int32)), pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], schema=schema
                )

        for batch in batches:
            for k in range(batch.num_rows):
                fold, lang, text = (batch.column(c)[k].as_py() for c in range(3))
                for part in blocks(text):
                    held.setdefault((fold, lang), []).append(grams(part))
                    size += len(part)
                    if size >= BLOCK:
                        yield from out()
                        held, size = {}, 0
            give_back()
        yield from out()

    rows = training.select(F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("fold"), "lang", "text")
    return rows.mapInArrow(count, "fold int, lang string, gram long, n long").groupBy("fold", "lang", "gram").agg(F.sum("n").alias("n"))


def blocks(text: str, size: int = BLOCK) -> Iterator[np.ndarray]:
    """Letter codes of a text in blocks that share ORDER - 1 letters, so that their grams are those of the whole."""
    if len(text) <= size:
        if len(codes := letter_codes(text)):
            yield codes
        return
    # runs that are no letters must not be cut in two: the last codes of a block are carried over
    carried, any_letter, told = np.zeros(1, U64), False, False
    for at in range(0, len(text), size):
        codes = _letter_table()[np.frombuffer(text[at : at + size].encode("utf-32-le", "surrogatepass"), np.uint32)]
        any_letter |= bool(codes.any())
        codes = _one_space(np.concatenate((carried, _packed(codes), np.zeros(1 if at + size >= len(text) else 0, U64))))
        if not any_letter:
            carried = codes[-1:]
            continue
        if len(codes) >= ORDER:
            yield codes
            codes, told = codes[1 - ORDER :], True
        carried = codes
    if any_letter and not told:
        yield carried


def _packed(codes: np.ndarray) -> np.ndarray:
    return ((codes & 0xFFFF) ^ (codes >> 16) * 0x9E37 & 0xFFFF).astype(U64)


def _one_space(codes: np.ndarray) -> np.ndarray:
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


# ---- the model ---------------------------------------------------------------------

_BITS = 16


def _masked(order: int) -> U64:
    return U64((1 << 16 * order) - 1)


class Table:
    """Rows of numbers found by the hashes of their keys: hashes in ascending order, with an index on the leading bits."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], rows[order]
        self.index = np.searchsorted(self.hashes, np.arange(1 << _BITS, dtype=U64) << U64(64 - _BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each key; the place is meaningless where nothing is found."""
        if not len(self.hashes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        hashes = mix(keys)
        at = self.index[(hashes >> U64(64 - _BITS)).astype(np.int64)]
        last = len(self.hashes) - 1
        live = np.flatnonzero(self.hashes[np.minimum(at, last)] < hashes)
        while len(live):
            at[live] += 1
            live = live[at[live] <= last]
            live = live[self.hashes[at[live]] < hashes[live]]
        at = np.minimum(at, last)
        return at, self.hashes[at] == hashes

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        at, found = self.find(keys)
        out = np.full((len(keys), self.rows.shape[1]), default, self.rows.dtype)
        out[found] = self.rows[at[found]]
        return out


def _dense(keys: np.ndarray, lang: np.ndarray, values: np.ndarray, languages: int, default: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and one row of values each, a column per language."""
    kinds, which = np.unique(keys, return_inverse=True)
    out = np.full((len(kinds), languages), default)
    out[which, lang] = values
    return kinds, out


def _discounted(lang: np.ndarray, gram: np.ndarray, n: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Each gram's discounted share of its context, and (lang, context, weight left to the lower order)."""
    order = np.lexsort((gram, lang))
    at, key, count = lang[order], gram[order] >> U64(16), n[order].astype(float)
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (at[1:] != at[:-1])))) if len(key) else np.zeros(0, np.int64)
    kinds = np.diff(np.append(first, len(key)))
    total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
    share = np.empty(len(key))
    share[order] = np.maximum(count - discount[at], 0) / np.repeat(total, kinds)
    return share, (at[first], key[first], discount[at[first]] * kinds / total)


def _shorter(lang: np.ndarray, gram: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Languages and grams without their first letter, and after how many different letters each was seen."""
    pairs, n = np.unique((lang.astype(U64) << U64(48)) | (gram & _masked(order)), return_counts=True)
    return (pairs >> U64(48)).astype(np.int64), pairs & _masked(3), n


class Low:
    """Bigrams and letters: P(last letter | the one before) in every language, from continuation counts."""

    def __init__(self, lang: np.ndarray, bigram: np.ndarray, n: np.ndarray, discount: np.ndarray, floor: float) -> None:
        size = len(discount)
        share, (at, context, weight) = _discounted(lang, bigram, n, discount[:, 1])
        self.bigrams, self.weights = Table(*_dense(bigram, lang, share, size, 0.0)), Table(*_dense(context, at, weight, size, 1.0))
        own, letter, m = _shorter(lang, bigram, 1)
        share, (at, context, weight) = _discounted(own, letter, m, discount[:, 0])
        left = np.ones(size)
        left[at] = weight
        letters, rows = _dense(letter, own, share, size, 0.0)
        self.letters, self.unseen = Table(letters, rows + left * floor), left * floor

    def probability(self, gram: np.ndarray) -> np.ndarray:
        at, found = self.letters.find(gram & _masked(1))
        one = np.tile(self.unseen, (len(gram), 1))
        one[found] = self.letters.rows[at[found]]
        return self.bigrams.get(gram & _masked(2), 0.0) + self.weights.get(gram >> U64(16) & _masked(1), 1.0) * one


class Shard:
    """The grams with certain middle letters: log probabilities in every language, and what unseen grams fall back to."""

    NAMES = ("grams", "left of grams", "trigrams", "left of trigrams")

    def __init__(self, low: Low, tables: Sequence[tuple[np.ndarray, np.ndarray]]) -> None:
        self.low = low
        self.grams, self.weights, self.trigrams, self.lower_weights = (Table(*t) for t in tables)

    @staticmethod
    def build(low: Low, lang: np.ndarray, gram: np.ndarray, n: np.ndarray, discount: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Keys and rows of the four tables, from the counts of all grams of the shard."""
        size = len(discount)
        share, weight = _discounted(lang, gram, n, discount[:, 3])
        own, trigram, m = _shorter(lang, gram, 3)
        lower_share, lower_weight = _discounted(own, trigram, m, discount[:, 2])
        contexts, left = _dense(lower_weight[1], lower_weight[0], lower_weight[2], size, 1.0)
        trigrams, three = _dense(trigram, own, lower_share, size, 0.0)
        three += Table(contexts, left).get(trigrams >> U64(16), 1.0) * low.probability(trigrams)
        out = [(trigrams, np.log(three)), (contexts, np.log(left))]
        contexts, left = _dense(weight[1], weight[0], weight[2], size, 1.0)
        grams_, four = _dense(gram, lang, share, size, 0.0)
        four += Table(contexts, left).get(grams_ >> U64(16), 1.0) * Table(trigrams, three).get(grams_ & _masked(3), 0.0)
        return [(grams_, np.log(four)), (contexts, np.log(left)), *out]

    def logs(self, gram: np.ndarray) -> np.ndarray:
        """Log probabilities of grams of this shard, a column per language."""
        at, found = self.grams.find(gram)
        if not len(self.grams.hashes):
            out = np.zeros((len(gram), self.low.unseen.shape[0]), np.float32)
        else:
            out = self.grams.rows[at]
        new = np.flatnonzero(~found)
        if len(new):
            kinds, which = np.unique(gram[new], return_inverse=True)
            place, known = self.trigrams.find(kinds & _masked(3))
            lower = np.empty((len(kinds), out.shape[1]))
            lower[known] = self.trigrams.rows[place[known]] if known.any() else 0
            rest = kinds[~known]
            lower[~known] = self.lower_weights.get(rest >> U64(16) & _masked(2), 0.0) + np.log(self.low.probability(rest))
            out[new] = (self.weights.get(kinds >> U64(16), 0.0) + lower)[which]
        return out


_FACTOR, _BITS_OF_24 = 0x45D9F3B, (1 << 24) - 1


def shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    """By the two middle letters; `_shard_column` is the same in Spark."""
    middle = gram >> U64(16) & _masked(2)
    return ((middle ^ middle >> U64(15)) * U64(_FACTOR) >> U64(8) & U64(_BITS_OF_24)) % U64(shards)


def _shard_column(shards: int) -> Column:
    middle = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit((1 << 32) - 1))
    mixed = F.shiftright(middle.bitwiseXOR(F.shiftright(middle, 15)) * F.lit(_FACTOR), 8)
    return mixed.bitwiseAND(F.lit(_BITS_OF_24)) % shards


@dataclass
class Model:
    """Where a fitted model lies: its languages, the folder of its shards and bigrams, the discounts per language and order."""

    languages: list[str]
    path: str = ""
    shards: int = 1
    discount: np.ndarray = field(default_factory=lambda: np.zeros((0, ORDER)))
    floor: float = 1.0
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _rows(path: str, schema: pa.Schema) -> list[np.ndarray]:
    """Columns of a written table, lists laid flat; a shard without grams has no folder."""
    system, root = fs.FileSystem.from_uri(path)
    if system.get_file_info(root).type == fs.FileType.NotFound:
        return [np.zeros(0, (f.type.value_type if pa.types.is_list(f.type) else f.type).to_pandas_dtype()) for f in schema]
    table = pq.read_table(root, filesystem=system, partitioning=None)
    columns = [table.column(c).combine_chunks() for c in schema.names]
    return [(c.flatten() if pa.types.is_list(c.type) else c).to_numpy(zero_copy_only=False) for c in columns]


_BIGRAMS = pa.schema([("lang", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
_SHARD = pa.schema([("name", pa.int32()), ("key", pa.int64()), ("logs", pa.list_(pa.float32()))])


@functools.lru_cache(maxsize=2)
def _low(path: str, discount: bytes, floor: float) -> Low:
    lang, bigram, n = _rows(f"{path}/bigrams", _BIGRAMS)
    return Low(lang.astype(np.int64), bigram.view(U64), n, np.frombuffer(discount).reshape(-1, ORDER), floor)


@functools.lru_cache(maxsize=1)
def _shard(path: str, k: int, discount: bytes, floor: float) -> Shard:
    name, key, logs = _rows(f"{path}/shards/shard={k}", _SHARD)
    rows = logs.reshape(len(key), len(discount) // (8 * ORDER))
    return Shard(_low(path, discount, floor), [(key[name == i].view(U64), rows[name == i]) for i in range(len(Shard.NAMES))])


def fit(counts: DataFrame, shard_bytes: int = SHARD_BYTES) -> Model:
    """Model from (lang, gram, n), a row for each gram of each language."""
    path = new_path(counts.sparkSession, "language-model")

    def shorter(df: DataFrame, order: int) -> DataFrame:
        cut = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        return df.groupBy("lang", cut).agg(F.count(F.lit(1)).alias("n"))

    trigrams = shorter(counts, 3)
    bigrams = written(shorter(trigrams, 2), "bigrams")
    letters = shorter(bigrams, 1)
    every = None
    for order, df in enumerate((letters, bigrams, trigrams, counts)):
        one = df.groupBy("lang").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
        one = one.withColumn("order", F.lit(order))
        every = one if every is None else every.unionByName(one)
    told = every.collect()
    languages = sorted({r["lang"] for r in told})
    if not languages:
        return Model([])
    discount = np.full((len(languages), ORDER), 0.5)
    for r in told:
        if r["ones"]:
            discount[languages.index(r["lang"]), r["order"]] = r["ones"] / (r["ones"] + 2 * r["twos"])
    floor = 1.0 / (1 + letters.select("gram").distinct().count())
    shards = max(1, -(-sum(r["all"] for r in told if r["order"] == ORDER - 1) * (16 + 8 * len(languages)) // shard_bytes))
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    bigrams.select(number.alias("lang"), "gram", "n").write.parquet(f"{path}/bigrams")
    flat = discount.tobytes()

    def build(table: pa.Table) -> pa.Table:
        lang, gram, n = (table.column(c).to_numpy() for c in ("lang", "gram", "n"))
        built = Shard.build(_low(path, flat, floor), lang.astype(np.int64), gram.view(U64), n, np.frombuffer(flat).reshape(-1, ORDER))
        key, rows = np.concatenate([t[0] for t in built]), np.concatenate([t[1] for t in built]).astype(np.float32)
        name = np.repeat(np.arange(len(built), dtype=np.int32), [len(t[0]) for t in built])
        logs = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
        shard = pa.array(np.full(len(key), table.column("shard")[0].as_py(), np.int64))
        return pa.table([shard, pa.array(name), pa.array(key.view(np.int64)), logs], names=["shard", *_SHARD.names])

    keyed = counts.select(number.alias("lang"), "gram", "n", _shard_column(shards).alias("shard"))
    built = keyed.groupBy("shard").applyInArrow(build, "shard long, name int, key long, logs array<float>")
    built.write.partitionBy("shard").parquet(f"{path}/shards")
    return Model(languages, path, shards, discount, floor, np.full(len(languages), np.inf))


# ---- judging ------------------------------------------------------------------------


def parts(model: Model, batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in small slices, so that few of their texts are Python strings at a time; whole ones where every part would load all
    shards anew."""
    for batch in batches:
        size = rows if model.shards == 1 else max(1, batch.num_rows)
        for k in range(0, batch.num_rows, size):
            yield batch.slice(k, size)
        give_back()


def entropies(model: Model, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Mean negative log probability per letter of each text in every language, and each text's number of letters."""
    sums, n = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    flat = model.discount.tobytes()

    def some() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        at, parts, held = [], [], 0
        for k, text in enumerate(texts):
            for codes in blocks(text or ""):
                at.append(k)
                parts.append(grams(codes))
                held += len(parts[-1])
                if held >= BLOCK // 2:
                    yield np.repeat(at, [len(p) for p in parts]), np.concatenate(parts)
                    at, parts, held = [], [], 0
        if parts:
            yield np.repeat(at, [len(p) for p in parts]), np.concatenate(parts)

    for shard in range(model.shards if model.languages else 0):
        table = _shard(model.path, shard, flat, model.floor)
        for at, gram in some():
            if shard == 0:
                n += np.bincount(at, minlength=len(texts))
            if model.shards > 1:
                mine = shard_of(gram, model.shards) == shard
                at, gram = at[mine], gram[mine]
            logs = table.logs(gram)
            for k in range(logs.shape[1]):
                sums[:, k] += np.bincount(at, weights=logs[:, k], minlength=len(texts))
    return -sums / np.maximum(n, 1)[:, None], n


def judge(model: Model, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(languages, scores, cross-entropies, letters, rejected); a score is the winner's share of the likelihoods per letter."""
    entropy, n = entropies(model, texts)
    if not model.languages:
        zero = np.zeros(len(texts))
        return [UND] * len(texts), zero, zero, n, np.ones(len(texts), bool)
    best, none = entropy.argmin(axis=1), n == 0
    low = entropy.min(axis=1)
    score = np.where(none, 0.0, 1.0 / np.exp(low[:, None] - entropy).sum(axis=1))
    reject = none | (low > model.limits[best] + SCATTER / np.sqrt(np.maximum(n, 1)))
    return [UND if none[k] else model.languages[b] for k, b in enumerate(best)], score, low, n, reject


def train(documents: DataFrame) -> Model:
    """Learn from text and language of all documents with a language that are not held out; levels by cross-fitting over two halves."""
    training = documents.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = written(gram_counts(training), "gram-counts")
    model = fit(written(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "all-gram-counts"))
    if not model.languages:
        return model
    fold = F.pmod(F.xxhash64("text"), F.lit(2))
    levels = None
    for k in range(2):
        part = _own_entropy(training.where(fold == k), fit(counts.where(F.col("fold") != k).select("lang", "gram", "n")))
        levels = part if levels is None else levels.unionByName(part)
    high = F.percentile_approx("level", CALIBRATED, 10_000).alias("high")
    told = {r["lang"]: r for r in levels.groupBy("lang").agg(high, F.count(F.lit(1)).alias("n")).collect()}
    random = -np.log(model.floor)
    for k, lang in enumerate(model.languages):
        n, level = (told[lang]["n"], told[lang]["high"]) if lang in told else (0, 0.0)
        model.limits[k] = (n * level + SHRINK * random) / (n + SHRINK) + MARGIN
    return model


def _own_entropy(training: DataFrame, model: Model) -> DataFrame:
    """(lang, level) of each text in its own language, less what chance may add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {lang: k for k, lang in enumerate(model.languages)}
        for batch in parts(model, batches):
            entropy, n = entropies(model, batch.column("text").to_pylist())
            langs = batch.column("lang").to_pylist()
            known = [(lang, float(entropy[k, column[lang]] - SCATTER / np.sqrt(n[k]))) for k, lang in enumerate(langs) if lang in column and n[k]]
            columns = list(zip(*known, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())], ["lang", "level"])

    return training.mapInArrow(run, "lang string, level double")


def judged(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, entropy, n_letters and rejected for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(model, batches):
            pred, score, entropy, n, reject = judge(model, batch.column("text").to_pylist())
            columns = [pa.array(pred, pa.string()), pa.array(score), pa.array(entropy, mask=n == 0), pa.array(n), pa.array(reject)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "entropy", "n_letters", "rejected"])

    told = T.StructType.fromDDL("lang_pred string, score double, entropy double, n_letters long, rejected boolean")
    return documents.select("doc_id", "text").mapInArrow(run, T.StructType([documents.schema["doc_id"], *told.fields]))


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row; without a model one is trained on the same documents."""
    found = judged(documents, model or train(documents))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def known_language(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those that are rejected; models are trained on the same documents."""
    model = train(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(model, batches):
            reject = judge(model, batch.column("text").to_pylist())[-1]
            yield batch.filter(pa.array(~reject))

    return documents.mapInArrow(run, documents.schema)
