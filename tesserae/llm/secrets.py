"""Secret scan over an incremental blob ledger, with DataFrame functions alone.

Every version of a text is addressed by its SHA-256.  The ledger, a table in the shared folder, holds one row for
each blob and rule version that has been scanned; a run scans only the pairs it lacks, each different blob once,
and the spans are joined back to all paths that hold the blob.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, load, shared_dir

# The patterns of the base kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a maximal run is one match, so the length bound may stand in the pattern


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    order: int
    group: int = 0  # the group whose length counts
    least: int = 0
    hints: tuple[str, ...] = ()  # literals one of which every match contains; none: any text may match

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = [Rule("assign", 1, ASSIGN, 0, 2, 6), Rule("access", 1, ACCESS, 1, 0, 20, ("AKIA",)), Rule("hex", 1, HEX, 2, 0, 24)]
#: Kinds that the method adds: tokens with a fixed prefix, signed web tokens, key blocks, credentials in addresses.
ADDED = [
    Rule("forge", 1, r"gh[opsur]_[A-Za-z0-9]{36,}", 3, 0, 0, ("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 4, 0, 0, ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")),
    Rule("webkey", 1, r"AIza[A-Za-z0-9_-]{35}", 5, 0, 0, ("AIza",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 6, 0, 0, ("eyJ",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 7, 0, 0, ("PRIVATE KEY-----",)),
    Rule("login", 1, r"[a-z][a-z0-9+.-]{0,15}://[^\x20\x09-\x0D/:@]{1,64}:[^\x20\x09-\x0D/:@]{1,64}@", 8, 0, 0, ("://",)),
]
RULES = BASE + ADDED
LEDGER = "blob string, rule string, spans array<struct<start:int,end:int>>"
_PIECES = "array<struct<gap:int,hit:int,ok:boolean>>"


def _hinted(text: Column, rule: Rule) -> Column:
    found = F.lit(not rule.hints)
    for hint in rule.hints:
        found = found | text.contains(hint)
    return found


def _pieces(text: Column, rule: Rule) -> Column:
    """For each match of the rule its length, that of the text between it and the one before, and whether it is long enough.

    The texts between matches come from a split by the same pattern.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    ok = lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.group)) >= rule.least
    made = F.zip_with(gaps, found, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit"), ok(h).alias("ok")))
    return F.when(_hinted(text, rule) & text.rlike(rule.pattern), made).otherwise(F.array().cast(_PIECES))


def _addressed(versions: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"), *columns)


def scan(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The ledger rows (columns LEDGER) of the pairs of blob and rule version that the ledger so far lacks.

    Spans count code points, end exclusive; matches are the leftmost non-overlapping ones of each rule.  A null
    text is an empty one; other columns are not read.  What is unseen is found by digests alone; if nothing is, no
    text is scanned.  Copies are collapsed before and after the shuffle, so a blob that a third of the rows share
    is scanned once, and a text that lacks the literals of all rules to be scanned does not travel.  The places of
    a text's matches come from running sums, so the work is linear in their number.
    """
    names = [r.name for r in rules]
    texts = _addressed(versions, text_col)
    if ledger is None:
        todo = None
    else:
        known = ledger.where(F.col("rule").isin(names)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = texts.select("blob").distinct().join(known, "blob", "left").select("blob", F.coalesce("seen", F.array().cast("array<string>")).alias("seen"))
        todo = cut(todo.where(F.size("seen") < len(names)))
        lacking = todo.agg(*[F.coalesce(F.bool_or(~F.array_contains("seen", n)), F.lit(False)) for n in names]).first()
        rules = [r for r, lacks in zip(rules, lacking, strict=True) if lacks]
        if not rules:
            return versions.sparkSession.createDataFrame([], LEDGER)
    may = F.lit(False)
    for r in rules:
        may = may | _hinted(F.col("text"), r)
    blobs = texts.select("blob", F.when(may, F.col("text")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    if todo is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        blobs = blobs.join(todo, "blob")
    text = F.coalesce("text", F.lit(""))
    each = [F.when(~F.array_contains("seen", r.name), F.struct(F.lit(r.name).alias("rule"), _pieces(text, r).alias("pieces"))) for r in rules]
    rows = blobs.select("blob", F.explode(F.array_compact(F.array(*each))).alias("x")).select("blob", "x.rule", F.posexplode_outer("x.pieces").alias("k", "p"))
    ends = rows.selectExpr("blob", "rule", "p", "cast(sum(p.gap + p.hit) over (partition by blob, rule order by k) as int) as end")
    span = F.when(F.col("p.ok"), F.struct((F.col("end") - F.col("p.hit")).alias("start"), "end"))
    return ends.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def findings(versions: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(id, blob, spans array<struct<start, ord, kind, end>>) for every row of ``versions``, from the ledger alone.

    Spans are sorted by start and the rules' order.  Repeated rows stay repeated; a row whose blob the ledger
    lacks has no spans.
    """
    label = lambda r: F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.lit(r.order).alias("ord"), F.lit(r.kind).alias("kind"), s["end"].alias("end")))
    hits = ledger.where(F.col("rule").isin([r.name for r in rules])).where(F.size("spans") > 0)
    hits = hits.select("blob", F.coalesce(*[F.when(F.col("rule") == r.name, label(r)) for r in rules]).alias("s"))
    hits = cut(hits.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_set("s"))).alias("s")))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    paths = _addressed(versions, text_col, F.col(id_col).alias("id")).select("id", "blob")
    return paths.join(hits, "blob", "left").select(F.col("id").alias(id_col), "blob", F.coalesce("s", none).alias("spans"))


def scan_into(path: str, versions: DataFrame, text_col: str = "text", rules: list[Rule] = RULES, first: bool = False) -> DataFrame:
    """Scans what the ledger at ``path`` lacks (``first``: there is none yet), appends it, and returns the whole ledger."""
    spark = versions.sparkSession
    so_far = None if first else spark.read.schema(LEDGER).parquet(path)
    scan(versions, so_far, text_col, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def op5_secret_ledger(spark, sf_dir: str) -> DataFrame:
    """Secrets of every text of ``documents``, by two runs over a ledger in the shared folder.

    The first run scans with the base rules.  The second has the longer rule list: it scans the pairs that the
    ledger lacks, which are those of the added rules.  A null text has no secrets; equal texts have equal ones.
    """
    docs, path = load(spark, sf_dir, "documents"), f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    scan_into(path, docs, rules=BASE, first=True)
    found = findings(docs, scan_into(path, docs, rules=RULES))
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))


_ORACLE_KIND = """
select rn, '{kind}' as kind, {ord} as ord, unnest(list_transform(range(1, len(m) + 1), lambda k: {{
    's': list_sum(list_transform(g[1:k], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0)::bigint,
    'e': list_sum(list_transform(g[1:k], lambda x: length(x)))::bigint + list_sum(list_transform(m[1:k], lambda x: length(x)))::bigint,
    'n': length({group})}})) as x
from (select rn, regexp_extract_all(text, '{pattern}', 0) as m, {groups} as q, string_split_regex(text, '{pattern}') as g from d where regexp_matches(text, '{pattern}'))
"""


def _oracle() -> str:
    parts = []
    for r in RULES:
        pattern = r.pattern.replace("'", "''")
        groups = f"regexp_extract_all(text, '{pattern}', {r.group})"
        parts.append(f"select rn, kind, ord, x.s as s, x.e as e from ({_ORACLE_KIND.format(kind=r.kind, ord=r.order, pattern=pattern, groups=groups, group='q[k]')}) where x.n >= {r.least}")
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as text from documents),
f as ({' union all '.join(parts)}),
a as (select rn, count(*) filter (ord = 0) as n_assign, count(*) filter (ord = 1) as n_access, count(*) filter (ord = 2) as n_hex,
      string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (ord < 3) as base, string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) as spans from f group by rn)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join a using (rn)
"""


ORACLE = _oracle()
