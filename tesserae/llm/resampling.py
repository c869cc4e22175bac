"""Resampling of documents towards a target distribution of hashed n-grams, by the algebra of CRCs.

A CRC-32 is linear over GF(2): crc(a + b) = M(|b|) crc(a) xor crc(b), where M(n) is a 32 x 32 bit matrix that stands
for n zero bytes.  So the CRC of each word is computed once, and that of an n-gram, words joined by spaces, is
composed from those of the n-gram one word shorter and of its last word; no n-gram's text is ever made.

Two scans of the documents: the first sums features by bucket (partial sums a task), the second adds up each
document's gains.  Ranks come from the counts of documents by score, whose number is bounded by the scores' range, and
from windows inside a score, so nothing sorts the whole table in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, load, written

BUCKETS = 10_000
ORDER = 2  # words of the longest n-gram
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 25
SEED = 7
BLOCK = 1 << 17  # words at a time
STEPS = 24  # bytes of words that go through the table together; longer words go alone
TABLES = 64  # lengths with a table of their own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A bit matrix, given by its 32 columns, times the vectors in x."""
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
    return out


def _bytewise(columns: np.ndarray) -> np.ndarray:
    """The matrix as four tables, one for each byte of a vector."""
    return np.stack([_apply(columns, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


class CrcAlgebra:
    """The CRC-32 of words and of their compositions."""

    def __init__(self):
        self.table = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)  # a byte's step of the register
        one = self.table[np.array([1 << b if b < 8 else 0 for b in range(32)])] ^ np.array([(1 << b) >> 8 for b in range(32)], np.uint32)  # a zero byte
        shifts, columns = [_bytewise(np.uint32(1) << np.arange(32, dtype=np.uint32))], one
        for _ in range(1, TABLES):
            shifts.append(_bytewise(columns))
            columns = _apply(one, columns)
        self.short = np.stack(shifts)  # by length
        powers, columns = [], one
        for _ in range(40):
            powers.append(_bytewise(columns))
            columns = _apply(columns, columns)
        self.powers = powers  # 1, 2, 4, ... zero bytes
        self.space = np.uint32(zlib.crc32(b" "))

    def shift(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """M(length) crc for each pair."""
        at = lambda t, x: t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]
        near = np.minimum(lengths, TABLES - 1)
        out = self.short[near, 0, crcs & 255] ^ self.short[near, 1, crcs >> 8 & 255] ^ self.short[near, 2, crcs >> 16 & 255] ^ self.short[near, 3, crcs >> 24]
        for i in np.flatnonzero(lengths >= TABLES):
            x = crcs[i : i + 1]
            for bit in range(int(lengths[i]).bit_length()):
                if int(lengths[i]) >> bit & 1:
                    x = at(self.powers[bit], x)
            out[i] = x[0]
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The CRC of each word, a byte of all words at a time, longer words first."""
        order = np.argsort(np.minimum(lengths, 65535).astype(np.uint16), kind="stable")[::-1]
        at, size = starts[order], lengths[order]
        crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
        more = np.searchsorted(-size, -np.arange(min(STEPS, int(size[0]) if len(size) else 0)), "left")  # words of more than k bytes
        for k, m in enumerate(more):
            x = crc[:m]
            crc[:m] = self.table[(x ^ data[at[:m] + k]) & 255] ^ x >> 8
        crc ^= np.uint32(0xFFFFFFFF)
        for i in range(int(np.searchsorted(-size, -STEPS, "left"))):
            crc[i] = zlib.crc32(data[at[i] : at[i] + size[i]])
        out = np.empty_like(crc)
        out[order] = crc
        return out


def features(data: np.ndarray, ends: np.ndarray, algebra: CrcAlgebra, order: int = ORDER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, texts, CRCs) of the n-grams of texts that lie end to end in ``data``, some words at a time.

    ``ends`` has the end of each text.  Words are the runs of ASCII letters and digits and of bytes beyond ASCII; A-Z count as a-z.
    """
    data = _LOWER[data]
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = ends[ends < len(data)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = ends[ends > 0] - 1
    last[cuts] = inside[cuts]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    del inside, first, last
    for lo in range(0, len(starts), BLOCK):
        back = min(lo, order - 1)  # words before the block with which its n-grams begin
        at = starts[lo - back : lo + BLOCK]
        size = stops[lo - back : lo + BLOCK] - at
        text = np.searchsorted(ends, at, "right")
        word = algebra.words(data, at, size)
        yield 1, text[back:], word[back:]
        if order > 1:
            tail = algebra.shift(np.full(len(at), algebra.space), size) ^ word  # of a space and the word
        gram = word
        for n in range(2, order + 1):
            gram = algebra.shift(gram[:-1], size[n - 1 :] + 1) ^ tail[n - 1 :]  # each ends with the word n - 1 places on
            skip = max(0, back - n + 1)
            ends_here, begins = text[n - 1 + skip :], text[skip : max(0, len(text) - n + 1)]
            same = ends_here == begins
            yield n, ends_here[same], gram[skip:][same]


def _laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts end to end, and where each text ends."""
    texts = texts.cast(pa.large_string())
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[places[0] : places[-1]]
    return data, places[1:] - places[0]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """Features by bucket over all rows; null texts have none.  A task emits a row a bucket, and the driver gets as many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        algebra, total = CrcAlgebra(), np.zeros(buckets, np.int64)
        for b in bounded(batches, 0):
            for _, _, crcs in features(*_laid_out(b.column(0)), algebra, order):
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["bucket", "n"])

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(count, "bucket int, n long")
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares of each bucket, rounded down."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, n_words, n_features, weight): the mean gain over a text's features, rounded down; 0 for a text without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        algebra, worth = CrcAlgebra(), gain.astype(np.float64)
        for b in bounded(batches, 1):
            n, words, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for k, text, crcs in features(*_laid_out(b.column(1)), algebra, order):
                found = np.bincount(text, minlength=len(n))
                n += found
                words += found if k == 1 else 0
                total += np.bincount(text, worth[crcs % np.uint32(len(gain))], len(n)).astype(np.int64)  # whole numbers far below 2^53
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return given.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``weights`` with ``score``: the weight and a Gumbel noise in thousandths that the seed and the id fix; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + noise.cast("long"))


def draw(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with ``rank``, 1 for the highest score, of the drawn rows; null for the others.

    Of the rows with a score and at least ``least_words`` words, floor(percent * rows / 100) are drawn; ties go to the
    smaller id, and rows equal in both follow in any order.  ``scores`` is read twice and should be a table.
    The driver holds a row for each different score: they are whole numbers within some 60,000 of each other.
    """
    spark = scores.sparkSession
    able = F.coalesce(F.col("score").isNotNull() & (F.col("n_words") >= least_words), F.lit(False))
    counts = sorted(((r["score"], r["n"]) for r in scores.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, before, above = percent * sum(n for _, n in counts) // 100, 0, []
    for score, n in counts:
        if before >= wanted:
            break
        above.append((score, before))
        before += n
    if not above:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    places = F.broadcast(spark.createDataFrame(above, "score long, before long"))
    least = above[-1][0]
    near = scores.where(able & (F.col("score") >= least)).join(places, "score")
    rank = F.row_number().over(Window.partitionBy("score").orderBy("id")) + F.col("before")
    drawn = near.withColumn("rank", F.when(rank <= wanted, rank).cast("long")).select(*scores.columns, "rank")
    return drawn.unionByName(scores.where(~(able & (F.col("score") >= least))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, order: int = ORDER, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank), a row for each row of ``docs``; other columns are not read.

    Null and empty texts have no features and the weight 0, repeated rows count as often as they stand; a null id has
    no score and is never drawn; an empty table gives an empty result, an empty target the gains of no features.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, order), bucket_counts(target, text_col, buckets, order))
    table = written(scored(weigh(docs, gain, id_col, text_col, order), seed), "resampling")
    return draw(table, percent, least_words).withColumnRenamed("id", id_col)


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """``documents`` resampled towards ``benchmark``; nulls, ties and repeated rows as in resample()."""
    out = resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")



ORACLE = r"""
with t as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1))) as steps),
texts as (
  select 0 as side, doc_id as id, text from documents union all select 1, item_id, text from benchmark
),
listed as (
  select side, id, row_number() over () as place_no, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
),
grams as (
  select side, id, place_no, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from listed
),
crcs as (
  select g, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(g))), lambda i: ('0x' || substr(hex(encode(g)), 2 * i + 1, 2))::bigint)), lambda c, x: xor(c >> 8, steps[xor(c, x) % 256 + 1])), 4294967295) % 10000 as bucket
  from (select distinct g from grams), t
),
counted as (
  select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from grams join crcs using (g) group by bucket
),
gains as (
  select b.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from grams where side = 0) + 10000)::double / ((coalesce(s, 0) + 1)::double * ((select count(*) from grams where side = 1) + 10000)::double)))::bigint as gain
  from (select unnest(range(10000)) as bucket) b left join counted using (bucket)
),
weights as (
  select place_no, count(*) as n_features, floor(sum(gain) / count(*))::bigint as weight from grams join crcs using (g) join gains using (bucket) where side = 0 group by place_no
),
scores as (
  select id as doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from listed left join weights using (place_no) where side = 0
),
ranked as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place, count(*) filter (n_words >= 20) over () as n from scores)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= 25 * n // 100 then place end as rank from ranked
"""
