"""Quality rules from a public tokenizer: how many characters its tokens cover, how often it falls back to bytes, how mixed its tokens are.

Text like the language has a usual fertility. Shouting, symbols glued to words,
lists of fragments and repeated words change characters per token or narrow
the spread of tokens. What is usual is measured over the whole corpus for each language and length
class, without counting equal rows twice; a document far outside is rejected.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.batches import slices, texts
from millrace.llm.encode import Known, for_task
from millrace.operators.joins import checked_broadcast
from millrace.session import stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
WINDOW = 8
SLICE = 512 << 10

FEATURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "n_tokens": pa.int64(),
    "chars_per_token": pa.float64(),
    "byte_share": pa.float64(),
    "entropy": pa.float64(),
}
_DDL = {pa.int64(): "long", pa.float64(): "double"}


@dataclass(frozen=True)
class Bands:
    """Rejection bands. A measure is rejected beyond ``spreads`` robust deviations from the median of its language and length
    class; the deviation is at least ``least`` of the median. A class with under ``few`` different rows takes as many as it lacks
    from the nearest length classes of its language; if a language has less in all, its bands are wider, by ``few`` over
    what it has. A byte share is rejected if it is beyond its band and more than ``byte_share`` over the median."""

    spreads: float = 5.0
    least_chars: float = 0.02
    least_entropy: float = 0.02
    byte_share: float = 0.2
    few: int = 50


class Pieces:
    """Ids of single words by a SentencePiece model, kept in the worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        if self.size > 1 << 16:
            raise ValueError("vocabulary too large for two-byte ids")
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.known = Known(self._ids, 200_000)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        found = self.model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        return [array("H", ids).tobytes() for ids in found]


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():  # equal runs have equal sums, so there are none
        return 0
    number: dict[bytes, int] = {}
    runs = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    size = 1
    while size < window:  # numbers of longer runs from those of their halves; exact
        step = min(size, window - size)
        pair = runs[: len(runs) - step] * (int(runs.max()) + 1) + runs[step:]
        runs = np.unique(pair, return_inverse=True)[1]
        size += step
    twice = np.bincount(runs)[runs] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[np.flatnonzero(twice)] += 1
    edge[np.flatnonzero(twice) + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(all_texts: list[str], model: Pieces) -> dict[str, list]:
    """The features of each text. Words are what ASCII white space leaves; each is encoded by itself."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in all_texts]
    known = model.known.learn(set().union(*split))
    out: dict[str, list] = {name: [] for name in FEATURES}
    for text, words in zip(all_texts, split):
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint16)
        n, chars = len(ids), len(text) - sum(map(text.count, BLANKS))
        counts = np.bincount(ids) if n > 4096 else np.unique(ids, return_counts=True)[1]
        share = counts[counts > 0] / max(n, 1)
        row = (
            len(words),
            chars,
            sum(map(text.count, SYMBOLS)),
            duplicate_lines(text),
            repeated_words(words),
            n,
            chars / n if n else None,
            float(model.is_byte[ids].mean()) if n else None,
            float(max(0.0, -(share * np.log2(share)).sum())) if n else None,
        )
        for column, value in zip(out.values(), row):
            column.append(value)
    return out


def with_features(docs: DataFrame, model_path: str, prefix: str = "", drop: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` without those to ``drop``, with the features behind them, stored once.

    ``docs`` needs ``text``; a null text has no words. ``prefix`` keeps the features
    apart from columns of the same names. No shuffle.
    """
    keep = [i for i, name in enumerate(docs.columns) if name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_task(Pieces, model_path) as model:
            for rows in slices(batches, limit=SLICE):
                found = measure(texts(rows), model)
                arrays = [*(rows.column(i) for i in keep), *(pa.array(found[name], kind) for name, kind in FEATURES.items())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*(rows.schema.names[i] for i in keep), *(prefix + name for name in FEATURES)])

    schema = StructType([docs.schema.fields[i] for i in keep])
    for name, kind in FEATURES.items():
        schema = schema.add(prefix + name, _DDL[kind])
    return stored(docs.mapInArrow(run, schema), "fertility")


def base_failed(col) -> Column:
    """Too few words, or too many in repeated runs. ``col`` maps a feature's name to its column."""
    return (col("n_words") < 20) | (100 * col("n_repeat_words") > 30 * col("n_words"))


def band_table(features: DataFrame, lang: str, prefix: str, bands: Bands) -> DataFrame:
    """Bands of each measure by language and length class; over all rows, equal ones once."""
    col = lambda name: F.col(prefix + name)
    rows = (
        features.where(~base_failed(col))
        .select(
            F.col(lang).alias("_lang"),
            length_class(col("n_tokens")).alias("_class"),
            F.round(col("chars_per_token"), 3).alias("c"),
            F.round(col("entropy"), 3).alias("e"),
            F.round(col("byte_share"), 3).alias("b"),
            col("n_tokens").alias("n"),
        )
        .distinct()
    )

    # rows by class, nearest classes first: what each class lacks comes from the next ones, in equal shares from either side
    sizes = stored(rows.groupBy("_lang", "_class").agg(F.count("*").alias("size")), "class-sizes")
    to = sizes.select(F.col("_lang").alias("_to_lang"), F.col("_class").alias("_to"))
    near = to.join(sizes, F.col("_to_lang").eqNullSafe(F.col("_lang"))).withColumn("away", F.abs(F.col("_to") - F.col("_class")))
    ring = Window.partitionBy("_lang", "_to", "away")
    nearer = Window.partitionBy("_lang", "_to").orderBy("away").rangeBetween(Window.unboundedPreceding, -1)
    lacks = F.greatest(F.lit(0), bands.few - F.coalesce(F.sum("size").over(nearer), F.lit(0)))
    share = F.when(F.col("away") == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), lacks / F.sum("size").over(ring)))
    taken = near.select(F.col("_lang").alias("_of_lang"), F.col("_class").alias("_of"), "_to", share.alias("share")).where("share > 0")
    taken = checked_broadcast(stored(taken, "class-shares"))

    ends = []
    for m, least in (("c", F.col("q")[1] * bands.least_chars), ("e", F.col("q")[1] * bands.least_entropy), ("b", F.lit(0.0))):
        # counts by rounded value keep the exact percentiles small; groupBy leaves one row for each value
        counted = rows.groupBy("_lang", "_class", m).agg(F.count("*").alias("k"))
        mine = counted.join(taken, F.col("_lang").eqNullSafe(F.col("_of_lang")) & (F.col("_class") == F.col("_of")))
        weight = F.ceil(F.col("k") * F.col("share") * 1000).cast("long")
        q = mine.groupBy("_lang", "_to").agg(F.percentile(m, [0.25, 0.5, 0.75], weight).alias("q"), F.sum(F.col("k") * F.col("share")).alias("n"))
        wider = F.greatest(F.lit(1.0), bands.few / F.col("n"))
        spread = F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349, least) * bands.spreads * wider
        spread = F.greatest(spread, F.lit(bands.byte_share)) if m == "b" else spread
        ends.append(q.select("_lang", F.col("_to").alias("_class"), (F.col("q")[1] - spread).alias(f"{m}_low"), (F.col("q")[1] + spread).alias(f"{m}_high")))
    out = ends[0]
    for other in ends[1:]:
        other = other.select(F.col("_lang").alias("_l"), F.col("_class").alias("_c"), *other.columns[2:])
        out = out.join(other, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_class").eqNullSafe(F.col("_c"))).drop("_l", "_c")
    return out


def length_class(n_tokens: Column) -> Column:
    return F.floor(F.log2(F.greatest(n_tokens, F.lit(1)))).cast("int")


def judged(features: DataFrame, lang: str = "lang", prefix: str = "", bands: Bands = Bands()) -> DataFrame:
    """Add ``base_failed`` and ``kept`` (under ``prefix``) to rows with features.

    A document is kept if it passes the base rules, its byte share, characters
    per token and token entropy lie within the bands of its language. A null language is one of its own.
    """
    col = lambda name: F.col(prefix + name)
    own = band_table(features, lang, prefix, bands)
    own = own.select(*(F.col(c).alias(f"_own_{c.lstrip('_')}") for c in own.columns))
    here = length_class(col("n_tokens"))
    own = checked_broadcast(stored(own, "bands"))
    joined = features.join(own, F.col(lang).eqNullSafe(F.col("_own_lang")) & (here == F.col("_own_class")), "left")
    inside = F.lit(True)
    for m, name in (("c", "chars_per_token"), ("e", "entropy"), ("b", "byte_share")):
        low, high = F.col(f"_own_{m}_low"), F.col(f"_own_{m}_high")
        value = F.round(col(name), 3)
        inside = inside & F.coalesce(value >= low, F.lit(True)) & F.coalesce(value <= high, F.lit(True))
    return joined.select(
        *(F.col(c) for c in features.columns),
        base_failed(col).alias(prefix + "base_failed"),
        (~base_failed(col) & inside).alias(prefix + "kept"),
    )


def keep_good(docs: DataFrame, model_path: str, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` only."""
    mark = "_fertility_"
    verdict = judged(with_features(docs, model_path, mark), prefix=mark, bands=bands)
    return verdict.where(F.col(mark + "kept")).select(*docs.columns)
