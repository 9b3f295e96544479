"""Queries on dedup, ids and query expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.driver.adapters import PARAMS
from leadloom.driver.registry import query, table
from leadloom.driver.text import CANONICAL_SQL
from leadloom.functions.ids import stable_id
from leadloom.operators.dedup import dedup_by_keys, dedup_candidates, dedup_counts, distinct_folded
from leadloom.operators.expansion import expand_queries
from leadloom.operators.order import circular_batch, with_position
from leadloom.params import Params
from leadloom.sources.web import seed_candidates


def _seeds(spark, sf_dir):
    return seed_candidates(table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("pos")), provider_rank=0)


@query("page_dedup", f"""
WITH {CANONICAL_SQL}
SELECT page_id, domain, canonical FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id) AS rn FROM canon) WHERE rn = 1""")
def page_dedup(spark, sf_dir):
    return dedup_candidates(_seeds(spark, sf_dir)).select(
        F.col("ord").alias("page_id"), F.col("provider_id").alias("domain"), F.col("profile_url").alias("canonical"))


@query("page_dedup_profile", f"""
WITH {CANONICAL_SQL} SELECT min(page_id) AS page_id, canonical FROM canon GROUP BY canonical""")
def page_dedup_profile(spark, sf_dir):
    kept = dedup_candidates(_seeds(spark, sf_dir), provider=False, domain=False)
    return kept.select(F.col("ord").alias("page_id"), F.col("profile_url").alias("canonical"))


@query("dedup_counts", f"""
WITH {CANONICAL_SQL}
SELECT count(*) AS candidates_found, count(DISTINCT domain) AS unique_candidates,
       count(*) - count(DISTINCT domain) AS duplicates_prevented FROM canon""")
def dedup_counts_query(spark, sf_dir):
    seeds = _seeds(spark, sf_dir)
    return dedup_counts(seeds, dedup_candidates(seeds))


def _greedy_rounds(rounds: int) -> str:
    """The rounds of the ordered dedup written out as SQL; rows still open at the end are shown."""
    steps = ["open0 AS (SELECT DISTINCT l_orderkey AS a, l_partkey AS b, l_orderkey * 4294967296 + l_partkey AS ord FROM lineitem)"]
    for i in range(rounds):
        steps.append(f"ma{i} AS (SELECT a, min(ord) AS m FROM open{i} GROUP BY a)")
        steps.append(f"mb{i} AS (SELECT b, min(ord) AS m FROM open{i} GROUP BY b)")
        steps.append(f"won{i} AS (SELECT o.a, o.b, o.ord FROM open{i} o JOIN ma{i} x ON o.a = x.a AND o.ord = x.m "
                     f"JOIN mb{i} y ON o.b = y.b AND o.ord = y.m)")
        steps.append(f"open{i + 1} AS (SELECT * FROM open{i} WHERE a NOT IN (SELECT a FROM won{i}) AND b NOT IN (SELECT b FROM won{i}))")
    kept = " UNION ALL ".join(f"SELECT a, b FROM won{i}" for i in range(rounds))
    return (f"WITH {', '.join(steps)} SELECT a AS l_orderkey, b AS l_partkey FROM ({kept} "
            f"UNION ALL SELECT -a, b FROM open{rounds})")


@query("multi_key_dedup", _greedy_rounds(12))
def multi_key_dedup(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct().withColumn(
        "ord", F.shiftleft("l_orderkey", 32) + F.col("l_partkey"))
    keys = F.array(F.concat(F.lit("order:"), F.col("l_orderkey")), F.concat(F.lit("part:"), F.col("l_partkey")))
    return dedup_by_keys(pairs, "ord", keys).select("l_orderkey", "l_partkey")


@query("stable_ids", f"""
WITH {CANONICAL_SQL},
keys AS (
  SELECT 'provider' AS kind, page_id AS row_id, 'WEB:' || domain AS k FROM canon
  UNION ALL SELECT 'domain', page_id, 'domain:' || domain FROM canon
  UNION ALL SELECT 'profile', page_id, 'profile:' || canonical FROM canon
  UNION ALL SELECT 'email', c_custkey, 'email:' || lower(replace(c_name, '#', '.')) || '@shop.test' FROM customer
  UNION ALL SELECT 'fallback', doc_id, 'fallback:' || lower('DOC|UNKNOWN|UNKNOWN|' || left(text, 120)) FROM documents)
SELECT kind, row_id, substring(sha256(k), 1, 24) AS lead_id FROM keys""")
def stable_ids(spark, sf_dir):
    pages, blank = table(spark, sf_dir, "pages"), F.lit("")
    customers, documents = table(spark, sf_dir, "customer"), table(spark, sf_dir, "documents")
    empty = {"provider_id": blank, "website": blank, "profile_url": blank, "description": blank}

    def ids(df, kind, row_id, email=blank, **given):
        columns = {**empty, "source": F.lit("WEB"), "name": F.lit("UNKNOWN"), "username": F.lit("UNKNOWN"), **given}
        rows = df.select(F.lit(kind).alias("kind"), F.col(row_id).alias("row_id"), email.alias("_email"),
                         *[v.alias(n) for n, v in columns.items()])
        return rows.select("kind", "row_id", stable_id(F.col("_email")).alias("lead_id"))

    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    bare = F.regexp_replace(host, r"^www\.", "")
    return (ids(pages, "provider", "page_id", provider_id=F.concat(F.lit(" "), F.upper(bare)))
            .unionByName(ids(pages, "domain", "page_id", website=F.col("url"), profile_url=F.col("url")))
            .unionByName(ids(pages, "profile", "page_id", profile_url=F.col("url")))
            .unionByName(ids(customers, "email", "c_custkey",
                             email=F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Shop.Test"))))
            .unionByName(ids(documents, "fallback", "doc_id", source=F.lit("DOC"), description=F.col("text"))))


_TYPES_SQL = """
niches AS (SELECT lower(p_type) AS niche, min(p_partkey) AS niche_pos FROM part GROUP BY 1
           UNION ALL SELECT 'real_estate', -2 FROM part GROUP BY ALL UNION ALL SELECT 'fitness', -1 FROM part GROUP BY ALL),
terms AS (
  SELECT niche, niche_pos, unnest(CASE niche
           WHEN 'real_estate' THEN ['agent immobilier', 'real estate coach', 'immobilier conseils', 'realtor tips']
           WHEN 'fitness' THEN ['coach fitness', 'personal trainer', 'fitness tips', 'online coach', 'nutrition coach', 'musculation', 'perte de poids']
           ELSE [replace(niche, '_', ' ')] END) AS term,
         generate_subscripts(CASE niche
           WHEN 'real_estate' THEN ['agent immobilier', 'real estate coach', 'immobilier conseils', 'realtor tips']
           WHEN 'fitness' THEN ['coach fitness', 'personal trainer', 'fitness tips', 'online coach', 'nutrition coach', 'musculation', 'perte de poids']
           ELSE [replace(niche, '_', ' ')] END, 1) AS t FROM niches),
listed AS (
  SELECT niche_pos, t * 10 + e AS i, term || ending AS query FROM terms, (VALUES (0, ''), (1, ' english'), (2, ' français')) AS x(e, ending)
  UNION ALL
  SELECT niche_pos, 1000 + c, creator || ' ' || replace(niche, '_', ' ') FROM niches, (VALUES (0, 'coach'), (1, 'Coach'), (2, 'mentor')) AS y(c, creator)),
ranked AS (SELECT *, row_number() OVER (ORDER BY niche_pos, i) AS seq FROM listed),
firsts AS (SELECT arg_min(query, seq) AS query, min(seq) AS seq FROM ranked GROUP BY lower(query)),
queries AS (SELECT query, row_number() OVER (ORDER BY seq) - 1 AS pos FROM firsts)"""

_EXPANSION = Params(as_of=PARAMS.as_of, target_languages=("en", "fr", "nl"), creator_types=("coach", "Coach", "mentor", "other"))


def _niches(spark, sf_dir):
    """Part types in order of appearance, after two known niches."""
    part = table(spark, sf_dir, "part")
    types = part.groupBy(F.lower("p_type").alias("niche")).agg(F.min("p_partkey").alias("niche_pos"))
    some = part.agg(F.count(F.lit(1))).select(
        F.explode(F.array(F.struct(F.lit("real_estate").alias("niche"), F.lit(-2).cast("bigint").alias("niche_pos")),
                          F.struct(F.lit("fitness").alias("niche"), F.lit(-1).cast("bigint").alias("niche_pos")))).alias("n")).select("n.*")
    return types.unionByName(some)


def _queries(spark, sf_dir):
    return with_position(expand_queries(_niches(spark, sf_dir), _EXPANSION), [F.col("query_ord")]).select("query", "pos")


@query("query_expand", f"WITH {_TYPES_SQL} SELECT query, pos FROM queries")
def query_expand(spark, sf_dir):
    return _queries(spark, sf_dir)


@query("query_batch", f"""
WITH {_TYPES_SQL}, n AS (SELECT count(*) AS n FROM queries)
SELECT query, (pos - 45 + 10 * n) % n AS turn, (45 + 20) % n AS next_offset FROM queries, n WHERE (pos - 45 + 10 * n) % n < 20""")
def query_batch(spark, sf_dir):
    batch, following = circular_batch(_queries(spark, sf_dir), offset=45, limit=20)
    return batch.select("query", "turn", F.lit(following).cast("bigint").alias("next_offset"))


@query("folded_distinct", """
WITH spelled AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN '  ' || upper(p_name) ELSE replace(p_name, ' ', '   ') END AS t FROM part)
SELECT trim(arg_min(t, p_partkey)) AS t, min(p_partkey) AS p_partkey FROM spelled
GROUP BY lower(trim(regexp_replace(t, '\\s+', ' ', 'g')))""")
def folded_distinct(spark, sf_dir):
    spelled = F.when(F.col("p_size") > 25, F.concat(F.lit("  "), F.upper("p_name"))).otherwise(
        F.replace("p_name", F.lit(" "), F.lit("   ")))
    return distinct_folded(table(spark, sf_dir, "part").select("p_partkey", spelled.alias("t")), "t", "p_partkey")
