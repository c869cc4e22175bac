"""Near-duplicate lines by a deletion-neighbourhood join, with DataFrame functions alone.

A line is lower-cased and its white space collapsed.  The edit distance between lines counts words, and the
bound is one edit at a similarity (1 - distance / longer length) of 0.8: lines of 5 words and more may differ in
one word, or one of them may lack a word (so 4 words against 5); shorter lines have a bound of 0, as one word in
four is more than a fifth.

Each different line that can have a partner emits a hashed key for itself and for each of its variants with one
word deleted.  Lines within the bound share a key.  Within a key the earliest partner of the right kind is a
minimum, so no pairs are formed (keys that very many lines share take partial minima); the distance to it is then verified on the texts.

Which lines can have a partner is known beforehand without loss: one edit leaves the first or the second half of
the words whole.  A line whose halves no other line has emits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, load, written

LEAST_WORDS = 5  # of the longer line; 1 - 1 / 5 is the similarity 0.8
BROADCAST_LINES = 300_000  # tables of up to so many lines or keys (some 30 MB) are broadcast; larger ones are shuffled
HOT_KEY = 10_000  # keys of more rows than this are taken apart
_MASK = (1 << 42) - 1  # sums of up to two million of these fit into a long


def _clean(line: Column) -> Column:
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r")
    return F.lower(F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line)))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, line, norm) for every line with a visible character; ``line`` counts from 0."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.posexplode(F.split(text_col, "\n")).alias("line", "raw"))
    return rows.select("doc", "line", _clean(F.col("raw")).alias("norm")).where("norm <> ''")


def _ids() -> tuple[Column, Column]:
    return F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2")


def _halves() -> Column:
    """Hashes of a line's halves, as the shorter (or equal) of two lines and as the longer one; empty where the bound is 0.

    The halves of a pair are cut by the shorter one's length n: its first n div 2 words and its last n - n div 2.
    """
    side = lambda n, head: f"xxhash64({n}, {head}, " + (f"slice(w, 1, ({n}) div 2)" if head else f"slice(w, size(w) - ({n}) + ({n}) div 2 + 1, ({n}) - ({n}) div 2)") + ")"
    own, less = ([side(n, 1), side(n, 0)] for n in ("size(w)", "size(w) - 1"))
    return F.expr(f"case when size(w) >= {LEAST_WORDS} then array({', '.join(own + less)}) when size(w) = {LEAST_WORDS - 1} then array({', '.join(own)}) else cast(array() as array<bigint>) end")


def _variants(lines: DataFrame) -> DataFrame:
    """(key, cut, doc, line): cut is the deleted word's position from 1, or 0 for the line itself.

    The hash of a word sequence is taken of two sums over the hashes of its adjacent pairs (ends included), so a
    deletion changes three terms of each and the variants of a line cost as much as the line.
    """
    pair = lambda i, j, seed: f"(xxhash64({seed}, p[{i}], p[{j}]) & {_MASK}L)"
    total = lambda c: f"aggregate({c}, 0L, (x, y) -> x + y)"
    lines = lines.withColumn("p", F.expr("concat(array(''), split(norm, ' '), array(''))"))
    lines = lines.withColumns({f"a{s}": F.expr(f"transform(sequence(1, size(p) - 1), i -> {pair('i - 1', 'i', s)})") for s in (0, 1)})
    lines = lines.withColumns({f"s{s}": F.expr(total(f"a{s}")) for s in (0, 1)})
    left = lambda s: f"s{s} - a{s}[i - 1] - a{s}[i] + {pair('i - 1', 'i + 1', s)}"
    whole = "xxhash64(s0, s1, size(p))"
    keys = f"if(size(p) - 2 < {LEAST_WORDS}, array({whole}), transform(sequence(0, size(p) - 2), i -> if(i = 0, {whole}, xxhash64({left(0)}, {left(1)}, size(p) - 1))))"
    return lines.select("doc", "line", F.posexplode(F.expr(keys)).alias("cut", "key"))


def _within_one(a: str, b: str) -> Column:
    """Whether two word sequences have an edit distance of at most one."""
    same = f"zip_with({a}, {b}, (x, y) -> x <=> y)"
    back = f"zip_with(reverse({a}), reverse({b}), (x, y) -> x <=> y)"
    longest = f"greatest(size({a}), size({b}))"
    shared = lambda z: f"coalesce(nullif(array_position({z}, false), 0) - 1, {longest})"
    return F.expr(f"{shared(same)} + {shared(back)} >= {longest} - 1")


def _checked(keys: DataFrame) -> DataFrame:
    """A table of keys, to be broadcast if it is small."""
    keys = cut(keys)
    return F.broadcast(keys) if keys.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES else keys


def _candidates(docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, line, norm) of the first lines that share a half with another one."""
    halves = firsts.select("doc", "line", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    some = _checked(halves.join(cut(shared), "half", "left_semi").select("doc", "line").distinct())
    found = line_table(docs, id_col, text_col).join(some, ["doc", "line"], "left_semi")
    return cut(found.groupBy("doc", "line").agg(F.min("norm").alias("norm")))


def _crowded(keyed: DataFrame) -> DataFrame:
    """The minima of _partners() for keys that very many rows share: partial aggregates and joins, which split, in place of windows."""
    order = F.struct("doc", "line")
    near = cut(keyed.select("key", "cut", order.alias("o")))
    least = near.groupBy("key").agg(F.min("o").alias("any"), F.min(F.when(F.col("cut") == 0, F.col("o"))).alias("whole"))
    same = near.groupBy("key", "cut").agg(F.min("o").alias("same"))
    return near.join(cut(least), "key").join(cut(same), ["key", "cut"]).select("o", "cut", "any", "whole", "same")


def _partners(texts: DataFrame) -> DataFrame:
    """(doc, line, p) with the earliest earlier line within one edit, for those of ``texts`` that have one."""
    order = F.struct("doc", "line")
    keyed = _variants(texts)
    hot = _checked(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_KEY).select("key"))
    few = keyed.join(hot, "key", "left_anti").select("key", "cut", order.alias("o"), F.expr("count(*) over (partition by key) as n")).where("n > 1")
    few = few.selectExpr("o", "cut", "min(o) over (partition by key) as any", "min(if(cut = 0, o, null)) over (partition by key) as whole", "min(o) over (partition by key, cut) as same")
    both = few.unionByName(_crowded(keyed.join(hot, "key", "left_semi")))
    partner = F.expr("if(cut = 0, any, least(whole, same))")  # what lacks a word differently may be two edits away
    near = cut(both.select("o", partner.alias("p")).where("p < o").distinct())
    words = F.split("norm", " ")
    a, b = (texts.select(order.alias(k), words.alias(f"w_{k}")) for k in ("o", "p"))
    true = near.join(a, "o").join(b, "p").where(_within_one("w_o", "w_p"))
    return true.groupBy("o").agg(F.min("p").alias("p")).select("o.doc", "o.line", "p")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, line, kept_doc, kept_line, distance): each line that an earlier one within the bound precedes.

    Earlier means the smaller (doc, line).  ``kept`` is the first line with equal normal form
    (distance 0) or, for the first lines themselves and their copies, the earliest verified partner
    (distance 1).  Partners are not chained: a line may go for a partner that itself goes.  Blank
    lines, null texts and rows without an id give nothing; rows that share an id count as one
    document, and equal places in them as one line.
    """
    lines = line_table(docs, id_col, text_col)
    h1, h2 = _ids()
    order = F.struct("doc", "line")
    firsts = lines.select("doc", "line", h1, h2, F.split("norm", " ").alias("w"))
    firsts = firsts.select("h1", "h2", F.struct("doc", "line", _halves().alias("halves")).alias("x"))
    firsts = firsts.groupBy("h1", "h2").agg(F.min("x").alias("x"), F.count("*").alias("n")).select("h1", "h2", "n", "x.*")
    firsts = written(firsts, "lines")  # three branches use it
    true = _partners(_candidates(docs, firsts, id_col, text_col))
    lead = firsts.select("h1", "h2", "n", "doc", "line").join(true, ["doc", "line"], "left")
    lead = cut(lead.where("n > 1 or p is not null").select("h1", "h2", order.alias("first"), "p"))
    each = lines.select("doc", "line", h1, h2).join(lead, ["h1", "h2"]).withColumn("o", order)
    gone = each.where("p is not null or o > first")
    kept = F.expr("if(o > first, first, p)")
    return gone.select("doc", "line", kept["doc"].alias("kept_doc"), kept["line"].alias("kept_line"), F.expr("if(o > first, 0, 1)").alias("distance"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without their duplicate lines.  A document that loses its last visible line goes.

    All columns stay; ``length_col``, if there is one, is set to the new text's code points where the text changed.
    """
    gone = duplicate_lines(docs, id_col, text_col).groupBy("doc").agg(F.collect_set("line").alias("__gone"))
    both = docs.join(gone.withColumnRenamed("doc", "__doc"), F.col(id_col) == F.col("__doc"), "left")
    both = both.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split(F.col(f"`{text_col}`"), "\n")))
    left = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), __gone), i -> __lines[i]), '\\n')")
    # a list of one, taken apart: the text is made once, however often it is used below
    out = both.select("*", F.explode(F.array(F.when(F.col("__gone").isNotNull(), left))).alias("__new"))
    out = out.where("__new is null or trim(regexp_replace(__new, '\\\\s+', ' ')) <> ''")
    names = [c for c in docs.columns]
    made = {text_col: F.coalesce("__new", F.col(f"`{text_col}`"))}
    if length_col in names:
        made[length_col] = F.when(F.col("__new").isNotNull(), F.length("__new")).otherwise(F.col(f"`{length_col}`")).cast(docs.schema[length_col].dataType)
    return out.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in names])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The duplicate lines of ``documents``: (doc_id, line_no, kept_doc_id, kept_line_no, distance); nulls and ties as in duplicate_lines."""
    out = duplicate_lines(load(spark, sf_dir, "documents"))
    return out.withColumnsRenamed({"doc": "doc_id", "line": "line_no", "kept_doc": "kept_doc_id", "kept_line": "kept_line_no"})
