"""Secret scans by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the three base kinds and long mixed tokens. Their values' hashes are counted by distinct repositories
and owners over the whole corpus, in steps that pre-aggregate (hash, owner, repository) before each shuffle. A value
that MANY owners or MANY repositories have is a widely copied example; one that a single owner has in fewer
repositories, and that looks random, is live. The base spans always stay; live long tokens outside of them are added
as kind `owned`.

Positions are sums over a text's matches, in order, of the lengths of the pieces before them and of their own, in code
points, by a window; whether a long token is free of base spans follows from the ends before and the starts after it.
So the work grows with the number of matches. What is written in between holds lengths and hashes, no secrets.

Defined results: null or empty text has no spans; a very long text's matches are sorted as one group, bounded by that
text; ties and repeated rows each get their own result; a null owner is an owner of its own; an empty table gives no
rows; columns beside those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.textops import cut
from loomline.sources.readers import read_table

#: Fixed by the contract. {16,} and {14,} take the same maximal runs as + and a test of the length.
QUOTE = "[\"']?"
NAMES = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = NAMES + QUOTE + r"\x20*[:=]\x20*" + QUOTE + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LONG = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
MANY = 3


def _marks(text: Column, kind: int, pattern: str, fits, value=lambda m: m) -> Column:
    """array of each match in order: its kind, the length of the piece before it, its own, whether it counts, its value's hashes and whether that looks random."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))  # the piece after the last match has none
    made = F.transform(F.filter(pairs, lambda x: x["m"].isNotNull()), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["gap"].alias("gap"), F.length(x["m"]).cast("long").alias("length"), fits(value(x["m"])).alias("fits"),
        F.xxhash64(value(x["m"])).alias("h1"), F.xxhash64(F.lit("b"), value(x["m"])).alias("h2"), (F.size(F.array_distinct(F.split(value(x["m"]), ""))) >= 10).alias("random"),
    ))
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast("array<struct<kind:int,gap:bigint,length:bigint,fits:boolean,h1:bigint,h2:bigint,random:boolean>>"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", repository: Column | None = None, owner: Column | None = None, many: int = MANY) -> DataFrame:
    """One row a document: counts and digest of the base spans, all spans, how many are live or widely copied, and the most owners and repositories that one of its values has.

    owner: by default the source; repository: by default the owner's texts of one language.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.coalesce(F.col("lang"), F.lit("")) if repository is None else repository
    d = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"))
    t, always = F.col("text"), lambda v: F.lit(True)
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    marks = F.concat(
        _marks(t, 0, ASSIGN, lambda v: F.length(v) >= 12, lambda m: F.regexp_extract(m, ASSIGN, 2)),
        _marks(t, 1, ACCESS, always), _marks(t, 2, HEX, always), _marks(t, 3, LONG, mixed),
    )
    d = cut(d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", marks.alias("marks")))

    each = d.select("row", "owner", "repository", F.posexplode("marks").alias("pos", "s")).select("row", "owner", "repository", "pos", "s.*")
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("pos"))).withColumn("start", F.col("end") - F.col("length")).where("fits")
    by_row, base, ahead = Window.partitionBy("row"), F.col("kind") < 3, (Window.unboundedPreceding, -1)
    before = F.max(F.when(base, F.col("end"))).over(by_row.orderBy("start", "kind").rowsBetween(*ahead))
    after = F.min(F.when(base, F.col("start"))).over(by_row.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(*ahead))  # a frame that shrinks would be counted anew for each row
    free = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))
    each = cut(each.withColumn("free", free).where("kind < 3 or free").select("row", "owner", "repository", "kind", "start", "end", "h1", "h2", "random"))

    by_repository = each.groupBy("h1", "h2", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("h1", "h2", "owner").agg(F.count("*").alias("repositories"))
    classes = cut(by_owner.groupBy("h1", "h2").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))  # a table of its own: Spark then splits a widely copied value's join
    judged = each.join(classes, ["h1", "h2"])
    copied = (F.col("owners") >= many) | (F.col("repositories") >= many)
    live = (F.col("owners") == 1) & ~copied & F.col("random")
    span, count = F.struct("start", "kind", "end"), lambda c: F.sum(F.when(c, 1).otherwise(0))
    per = judged.groupBy("row").agg(
        *(count(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS[:3])), count(live).alias("n_live"), count(copied).alias("n_copied"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"),
        F.collect_list(F.when(base, span)).alias("base"), F.collect_list(F.when(base | live, span)).alias("spans"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    found = d.select("row", "doc_id").join(per, "row", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(
        "doc_id", *map(number, ("n_assign", "n_access", "n_hex")), F.sha2(_joined(F.coalesce("base", none)), 256).alias("base_sha256"), _joined(F.coalesce("spans", none)).alias("spans"),
        *map(number, ("n_live", "n_copied", "most_owners", "most_repositories")),
    )


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, f"{sf_dir}/documents.parquet"))


def _found_sql(pattern: str) -> str:
    m, g = f"regexp_extract_all(t, $q${pattern}$q$)", f"string_split_regex(t, $q${pattern}$q$)"
    return f"select id, unnest(m) as m, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0))) as s from (select id, {m} as m, {g} as g from d)"


OP10_SQL = f"""
with d as (select doc_id, source, lang, coalesce(text, '') as t, row_number() over () as id from documents),
a as ({_found_sql(ASSIGN)}), k as ({_found_sql(ACCESS)}), h as ({_found_sql(HEX)}), l as ({_found_sql(LONG)}),
b as (select id, 0 as k, s, s + len(m) as e, regexp_extract(m, $q${ASSIGN}$q$, 2) as v from a where len(regexp_extract(m, $q${ASSIGN}$q$, 2)) >= 12
  union all select id, 1, s, s + len(m), m from k union all select id, 2, s, s + len(m), m from h),
f as (select id, 3 as k, s, s + len(m) as e, m as v from l where regexp_matches(m, '[0-9]') and regexp_matches(m, '[a-z]') and regexp_matches(m, '[A-Z]') and not exists (select 1 from b where b.id = l.id and b.s < l.s + len(l.m) and l.s < b.e)),
c as (select * from b union all select * from f),
o as (select v, count(distinct coalesce('s' || source, 'n')) as owners, count(distinct (coalesce('s' || source, 'n'), coalesce(lang, ''))) as repositories from c join d using (id) group by v),
j as (select c.*, owners, repositories, owners >= {MANY} or repositories >= {MANY} as copied, owners = 1 and repositories < {MANY} and len(list_distinct(string_split(v, ''))) >= 10 as live, ['assign', 'access', 'hex', 'owned'][k + 1] || ':' || s::bigint || ':' || e::bigint as text from c join o using (v)),
g as (select id, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex, string_agg(text, ',' order by s, k, e) filter (k < 3) as base,
  string_agg(text, ',' order by s, k, e) filter (k < 3 or live) as spans, count(*) filter (live) as n_live, count(*) filter (copied) as n_copied, max(owners) as most_owners, max(repositories) as most_repositories from j group by id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied,
  coalesce(most_owners, 0) as most_owners, coalesce(most_repositories, 0) as most_repositories
from d left join g using (id)
"""
