"""The catalogue's operators applied to the driver's tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import blanks, dates, sequence, text
from strandlake.operators import alignment, curation, merge, quality, ranking, taxonomy, trees, validation
from strandlake.operators.shared import dealt, work_path
from strandlake.operators.store import TableStore
from strandlake.streaming import batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables (a callable of a table's name) as a query with its SQL."""
    def add(f):
        name = f.__name__
        QUERIES[name] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            SQL[name] = sql
        return f

    return add


def _hits(t) -> DataFrame:
    """Line items as hits: an order's best hit is its dearest line, the first of equal ones."""
    return t("lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_suppkey").alias("reference"), F.col("l_extendedprice").alias("identity"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("ord"))


BEST = "SELECT l_orderkey AS query, l_suppkey AS reference, l_extendedprice AS identity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1"


@query(f"WITH b AS ({BEST}) SELECT reference, CASE WHEN s_acctbal > 5000 THEN 'reference' ELSE 'query' END AS route, count(*) AS queries, round(sum(identity), 2) AS total FROM b JOIN supplier ON s_suppkey = reference GROUP BY ALL")
def hits_by_reference(t):
    """Flagship: best hits, routed by a lookup, counted by reference."""
    listed = t("supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("accession"))
    best = ranking.best_hit(_hits(t)).join(t("supplier").select(F.col("s_suppkey").alias("reference")), "reference")
    routed = quality.route(best.withColumn("exclusion_status", F.lit("0")), listed, "reference")
    return routed.groupBy("reference", "route").agg(F.count(F.lit(1)).alias("queries"), F.round(F.sum("identity"), 2).alias("total"))


@query(BEST)
def best_hit(t):
    return ranking.best_hit(_hits(t)).select("query", "reference", "identity")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def keep_last(t):
    return ranking.keep_last_record(t("events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def dedupe_content(t):
    return ranking.first_of_content(t("documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey % 10 != 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0) GROUP BY o_custkey")
def keyed_append(t):
    orders = t("orders").select("o_custkey", "o_orderkey")
    return merge.keyed_append(orders.filter("o_orderkey % 10 = 0"), orders.filter("o_orderkey % 10 != 0"), ["o_custkey"], "o_orderkey")[0]


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3, o_orderkey) = 1")
def stored_append(t):
    """Orders in three batches through the table store: the first order of each customer stays."""
    orders = t("orders").select("o_custkey", "o_orderkey")
    store = TableStore(orders.sparkSession, work_path(orders.sparkSession))
    for k in range(3):
        store.append_new("orders", orders.filter(F.col("o_orderkey") % 3 == k), datetime(2024, 1, 1), "o_orderkey")
    return store.read("orders")


@query("SELECT DISTINCT 'orders' AS table_name, o_custkey::VARCHAR AS key, 'duplicate key' AS reason, TIMESTAMP '2024-01-01 00:00:00' AS date FROM orders WHERE o_orderkey % 10 != 0 AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0)")
def duplicate_ledger(t):
    orders = t("orders").select("o_custkey", "o_orderkey")
    found = merge.keyed_append(orders.filter("o_orderkey % 10 = 0"), orders.filter("o_orderkey % 10 != 0"), ["o_custkey"], "o_orderkey")[1]
    return merge.duplicate_ledger(found, "orders", ["o_custkey"], "duplicate key", datetime(2024, 1, 1))


@query("SELECT DISTINCT trim(p_brand) AS p_brand, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM part")
def update_ledger(t):
    return merge.update_ledger(t("part"), datetime(2024, 1, 1), "p_brand")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders")
def upsert(t):
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return merge.upsert(orders, orders.filter("o_orderkey % 7 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), ["o_orderkey"])


@query("SELECT count(*) FILTER (o_orderkey % 7 != 0) AS inserted, count(*) FILTER (o_orderkey % 7 = 0) AS updated FROM orders")
def upsert_counts(t):
    orders = t("orders").select("o_orderkey")
    return merge.upsert_counts(orders.filter("o_orderkey % 7 = 0"), orders, ["o_orderkey"])


@query("""WITH r AS (SELECT 'A' || o_orderkey AS base, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 + 1 ELSE 1 END AS v, o_orderkey k FROM orders), l AS (SELECT 'A' || o_orderkey AS base, o_orderkey % 4 AS v FROM orders WHERE o_orderkey % 3 != 0), x AS (SELECT 'A' || o_orderkey AS base FROM orders WHERE o_orderkey % 11 = 0)
SELECT r.base || '.' || r.v AS new, CASE WHEN l.base IS NULL THEN 'NA' WHEN l.v > 0 THEN l.base || '.' || l.v ELSE l.base END AS old FROM r LEFT JOIN l USING (base) WHERE r.base NOT IN (SELECT base FROM x) AND (l.base IS NULL OR r.v > l.v)""")
def version_diff(t):
    key = F.col("o_orderkey")
    name = lambda v: F.concat(F.lit("A"), key.cast("string"), F.lit("."), v.cast("string")).alias("accession")
    remote = t("orders").select(name(F.when(key % 2 == 0, key % 5 + 1).otherwise(F.lit(1).cast("bigint"))))
    local = t("orders").filter("o_orderkey % 3 != 0").select(name(key % 4), key.alias("ord"))
    excluded = t("orders").filter("o_orderkey % 11 = 0").select(F.concat(F.lit("A"), key.cast("string")).alias("accession"))
    return merge.update_log(merge.version_diff(local, remote, excluded))


@query("SELECT coalesce(l.doc_id, d.doc_id)::VARCHAR AS id, CASE WHEN d.doc_id IS NULL THEN 'missing' ELSE 'extra' END AS state FROM (SELECT doc_id FROM labels WHERE quality = 1) l FULL JOIN (SELECT doc_id FROM documents WHERE lang = 'en') d USING (doc_id) WHERE l.doc_id IS NULL OR d.doc_id IS NULL")
def reconcile(t):
    as_id = F.col("doc_id").cast("string").alias("id")
    return validation.reconcile(t("labels").filter("quality = 1").select(as_id), t("documents").filter("lang = 'en'").select(as_id))


@query("SELECT c_custkey, 'order' AS origin FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'none' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def union_by_priority(t):
    first = t("orders").select(F.col("o_custkey").alias("c_custkey")).distinct().join(t("customer").select("c_custkey"), "c_custkey").withColumn("origin", F.lit("order"))
    return validation.union_by_priority(first, t("customer").select("c_custkey", F.lit("none").alias("origin")), "c_custkey")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN coalesce(source, '') ELSE lang END AS lang FROM documents")
def fill_missing(t):
    docs = t("documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("lang"))
    fill = t("documents").select("doc_id", F.coalesce("source", F.lit("")).alias("lang"), F.col("doc_id").alias("ord"))
    return curation.fill_missing(docs, fill, ["lang"], "doc_id")


@query("SELECT n_name, CASE n_regionkey WHEN 0 THEN 'AFR' ELSE 'other' END AS host FROM (SELECT n_name, n_regionkey FROM nation)")
def replace_values(t):
    rows = t("nation").select("n_name", F.col("n_regionkey").cast("string").alias("host"))
    replacements = t("region").select(F.col("r_regionkey").cast("string").alias("host"), F.when(F.col("r_regionkey") == 0, "AFR").otherwise("other").alias("replaced_by"), F.col("r_regionkey").alias("ord"))
    return curation.replace_values(rows, replacements)


@query("""WITH x AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS r, l_linenumber::VARCHAR AS n FROM lineitem)
SELECT l_orderkey AS key, max(n) FILTER (r = 1) AS best, string_agg(n, ';' ORDER BY r) AS names FROM x GROUP BY l_orderkey""")
def alternatives(t):
    rows = t("lineitem").withColumn("ord", F.struct("l_linenumber", "l_partkey"))
    return ranking.alternatives(rows, F.col("l_orderkey"), F.col("l_extendedprice").cast("string"), F.col("l_linenumber").cast("string")).select("key", "best", "names")


@query("WITH f AS (SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type, '; ' ORDER BY o) AS event_type FROM f GROUP BY user_id")
def distinct_in_order(t):
    return ranking.distinct_in_order(t("events"), "user_id", "event_type", "event_id")


COUNTS = ", ".join(f"(length(upper(text)) - length(replace(upper(text), '{x}', '')))::BIGINT AS {x.lower()}" for x in "ATGCN")


@query(f"SELECT doc_id, {COUNTS}, a + t + g + c AS real_length FROM documents")
def base_counts(t):
    return t("documents").select("doc_id", *(c.cast("bigint").alias(n) for n, c in sequence.base_counts(F.col("text")).items()))


@query(f"SELECT doc_id, sha256(reverse(translate(text, '{sequence.CODES}', '{sequence.COMPLEMENTS}'))) AS digest FROM documents")
def reverse_complement(t):
    return t("documents").select("doc_id", F.sha2(sequence.reverse_complement(F.col("text")), 256).alias("digest"))


NAME_ROW = "replace(replace(lower(p_name), ' ', '-'), 'a', '-')"


@query(f"""WITH b AS (SELECT p_partkey, unnest(range(1, length(s) + 1)) AS i, s FROM (SELECT p_partkey, {NAME_ROW} AS s FROM part)), g AS (SELECT p_partkey, i, i - row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS run FROM b WHERE s[i:i] = '-')
SELECT p_partkey, min(i)::BIGINT AS start, max(i)::BIGINT AS "end" FROM g GROUP BY p_partkey, run""")
def gap_ranges(t):
    row = F.replace(F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("a"), F.lit("-"))
    return t("part").select("p_partkey", F.explode(sequence.gap_ranges(row)).alias("r")).select("p_partkey", F.col("r.start").cast("bigint").alias("start"), F.col("r.end").cast("bigint").alias("end"))


@query("""WITH f AS (SELECT n_nationkey * 40 AS a, n_nationkey * 40 + 60 AS b, n_name AS product FROM nation)
SELECT event_id, product, greatest(event_id % 1000, a)::BIGINT AS aln_start, least(event_id % 1000 + user_id % 50, b)::BIGINT AS aln_end FROM events JOIN f ON event_id % 1000 + user_id % 50 >= a AND event_id % 1000 <= b""")
def overlaps(t):
    ranges = t("events").select("event_id", (F.col("event_id") % 1000).alias("start"), (F.col("event_id") % 1000 + F.col("user_id") % 50).alias("end"))
    features = t("nation").select((F.col("n_nationkey") * 40).cast("bigint").alias("feature_start"), (F.col("n_nationkey") * 40 + 60).cast("bigint").alias("feature_end"), F.col("n_name").alias("product"))
    return alignment.overlaps(ranges, features).select("event_id", "product", "aln_start", "aln_end")


SPANS = ("CASE WHEN event_id % 50 = 7 THEN 4000 + user_id * 3 ELSE user_id % 40 END", "CASE WHEN p_partkey % 40 = 3 THEN 90000 ELSE p_size * 5 END")


@query(f"""WITH f AS (SELECT p_partkey AS part, p_partkey * 50 AS a, p_partkey * 50 + {SPANS[1]} AS b FROM part), e AS (SELECT event_id * 13 % 100000 AS s, event_id * 13 % 100000 + {SPANS[0]} AS e FROM events)
SELECT part, count(*) AS ranges, sum(least(e, b) - greatest(s, a) + 1)::BIGINT AS shared FROM e JOIN f ON e >= a AND s <= b GROUP BY part""")
def nested_overlaps(t):
    """Long and short ranges against long and short features, in nested bins."""
    start = F.expr("event_id * 13 % 100000")
    ranges = t("events").select(start.alias("start"), (start + F.expr(SPANS[0])).alias("end"))
    features = t("part").select((F.col("p_partkey") * 50).alias("feature_start"), (F.col("p_partkey") * 50 + F.expr(SPANS[1])).alias("feature_end"), F.col("p_partkey").alias("product"))
    met = alignment.overlaps(ranges, features, bin_width=64, small=0)
    return met.groupBy(F.col("product").alias("part")).agg(F.count(F.lit(1)).alias("ranges"), F.sum(F.col("aln_end") - F.col("aln_start") + 1).alias("shared"))


@query("""WITH f AS (SELECT p_partkey AS o, p_partkey * 30 AS a, p_partkey * 30 + 100 AS b FROM part), n AS (SELECT e.event_id AS id, event_id % 5000 AS s, event_id % 5000 + 95 + user_id % 10 AS e, a, b, o FROM events e JOIN f ON abs(event_id % 5000 - a) <= 10 AND abs(event_id % 5000 + 95 + user_id % 10 - b) <= 10)
SELECT id, CASE WHEN s > a THEN '<' ELSE '' END || s AS start_mark, CASE WHEN e < b THEN '>' ELSE '' END || e AS end_mark FROM n QUALIFY row_number() OVER (PARTITION BY id ORDER BY o) = 1""")
def within_tolerance(t):
    rows = t("events").select(F.col("event_id").alias("id"), (F.col("event_id") % 5000).alias("start"), (F.col("event_id") % 5000 + 95 + F.col("user_id") % 10).alias("end"))
    features = t("part").select(F.col("p_partkey").alias("ord"), (F.col("p_partkey") * 30).alias("feature_start"), (F.col("p_partkey") * 30 + 100).alias("feature_end"))
    return alignment.within_tolerance(rows, features).select("id", "start_mark", "end_mark")


NODES = "n AS (SELECT p_partkey AS id, greatest(p_partkey // 2, 1) AS up, CASE p_partkey % 3 WHEN 0 THEN 'species' WHEN 1 THEN 'genus' ELSE 'order' END AS rank, p_name AS name FROM part)"
WALK = f"WITH RECURSIVE {NODES}, w AS (SELECT id AS tax_id, id AS ancestor, 0 AS depth FROM n UNION ALL SELECT w.tax_id, n.up, depth + 1 FROM w JOIN n ON n.id = w.ancestor WHERE n.up != n.id)"


def _nodes(t) -> DataFrame:
    key = F.col("p_partkey")
    return t("part").select(key.alias("tax_id"), F.greatest(F.floor(key / 2), F.lit(1)).cast("bigint").alias("parent_tax_id"), F.when(key % 3 == 0, "species").when(key % 3 == 1, "genus").otherwise("order").alias("rank"))


def _walk(t) -> DataFrame:
    return taxonomy.ancestors(t("part").select(F.col("p_partkey").alias("tax_id")), _nodes(t))


def _scientific(t) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("tax_id"), F.col("p_name").alias("name"))


@query(f"{WALK} SELECT * FROM w")
def ancestors(t):
    return _walk(t)


@query(f"{WALK} SELECT tax_id, {', '.join('NULL::VARCHAR AS ' + c for c in ('superkingdom', 'phylum', 'class', 'family'))}, min_by(name, depth) FILTER (rank = 'order') AS order_category, min_by(name, depth) FILTER (rank = 'genus') AS genus, min_by(name, depth) FILTER (rank = 'species') AS species FROM w JOIN n ON n.id = w.ancestor GROUP BY tax_id")
def lineage_columns(t):
    return taxonomy.lineage_columns(_walk(t), _nodes(t), _scientific(t))


@query(f"{WALK} SELECT ancestor AS lineage_taxa_id, a.name AS lineage_name, a.rank AS lineage_rank, tax_id AS desc_taxa_id, d.name AS desc_name, d.rank AS desc_rank FROM w JOIN n a ON a.id = ancestor JOIN n d ON d.id = tax_id")
def lineage_lookup(t):
    return taxonomy.lineage_lookup(_walk(t), _nodes(t), _scientific(t))


@query(f"WITH {NODES} SELECT c.name, c.id AS child_taxa_id, p.id AS parent_taxa_id, c.rank AS child_rank, p.rank AS parent_rank FROM n c JOIN n p ON c.up = p.id AND c.id != c.up")
def children(t):
    return taxonomy.children(t("part").select(F.col("p_partkey").alias("tax_id")), _nodes(t), _scientific(t))


@query("SELECT p_partkey, coalesce(nullif(regexp_extract(upper(regexp_replace(p_brand, 'Brand#', 'a h', 'g')), 'H([0-9]{1,2})', 0), ''), 'unknown') AS serotype FROM part")
def serotype(t):
    return t("part").select("p_partkey", text.serotype(F.regexp_replace("p_brand", "Brand#", "a h")).alias("serotype"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(p_type || ' (H1N1)/', '\(H\d{1}N\d{1}\)', '', 'g'), '[^a-zA-Z0-9/_-]', '_', 'g'), '_+', '_', 'g'), '[_/]+$', '', 'g') AS strain FROM part")
def clean_strain(t):
    return t("part").select("p_partkey", text.clean_strain(F.concat("p_type", F.lit(" (H1N1)/"))).alias("strain"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_type || ' ' ELSE p_type END AS strain FROM part")
def strain_in_definition(t):
    even = F.col("p_partkey") % 2 == 0
    return t("part").select("p_partkey", text.strain_in(F.concat(F.lit("Virus ("), F.col("p_type"), F.when(even, " (H1N1)").otherwise(""), F.lit(") gene (x)"))).alias("strain"))


@query("SELECT event_id, day(ts)::INTEGER AS d_day, month(ts)::INTEGER AS d_mon, year(ts)::INTEGER AS d_year, 'Yes' AS flag FROM events")
def split_dates(t):
    rows = t("events").select("event_id", F.date_format("ts", "d-MMM-yyyy").alias("d"))
    return dates.split_dates(rows, "d", "d_").select("event_id", "d_day", "d_mon", "d_year", dates.date_flag(F.col("d")).alias("flag"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'NA' ELSE 'Yes' END AS flag FROM events")
def date_flag(t):
    kind = F.col("event_id") % 3
    return t("events").select("event_id", dates.date_flag(F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd")).when(kind == 1, F.date_format("ts", " MMM-yyyy")).otherwise(F.date_format("ts", "yyyy"))).alias("flag"))


N = "(length(upper(text)) - length(replace(upper(text), 'N', '')))"


@query(f"""SELECT doc_id, CASE WHEN r IS NULL THEN '0' ELSE '1' END AS exclusion_status, coalesce(r, '') AS exclusion_criteria FROM (SELECT doc_id,
CASE WHEN length(text) - {N} < 400 THEN 'Real sequence length (length - Ns) less than the threshold' WHEN length(text) < 600 THEN 'Sequence length less than total length'
WHEN lang NOT IN ('en', 'fr', 'de') THEN 'GenBank division ' || lang || ' not in user-defined exclusion list' WHEN lang NOT IN ('en', 'fr') THEN 'GenBank division ' || lang || ' not in valid division list' END AS r FROM documents)""")
def quality_filter(t):
    rows = t("documents").select("doc_id", F.col("lang").alias("division"), F.length("text").cast("string").alias("length"), F.lit("").alias("n"), F.col("text").alias("sequence"), F.lit("0").alias("exclusion_status"), F.lit("").alias("exclusion_criteria"))
    return quality.quality_filter(rows, 600, 400, ["en", "fr", "de"], ["en", "fr"]).select("doc_id", "exclusion_status", "exclusion_criteria")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_custkey % 4 = 0 THEN 'reference' ELSE 'query' END AS route FROM orders")
def route(t):
    rows = t("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("exclusion_status"))
    return quality.route(rows, t("customer").filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("accession")), "o_custkey").select("o_orderkey", "route")


@query(f"WITH b AS ({BEST}) SELECT query, reference, identity FROM b WHERE reference % 3 != 0")
def drop_excluded_hits(t):
    kinds = t("supplier").select(F.col("s_suppkey").alias("accession"), F.when(F.col("s_suppkey") % 3 == 0, "exclusion_list").otherwise("reference").alias("kind"))
    return quality.drop_excluded_hits(ranking.best_hit(_hits(t)).select("query", "reference", "identity"), kinds)


@query(f"""WITH b AS ({BEST}) SELECT o_orderkey AS gi_number, CASE WHEN b.reference % 3 = 0 THEN '1' WHEN o_orderkey % 5 != 0 AND b.query IS NULL THEN '1' ELSE '0' END AS exclusion_status,
CASE WHEN b.reference % 3 = 0 THEN 'x; excluded: best BLAST hit is an exclusion_list reference' WHEN o_orderkey % 5 != 0 AND b.query IS NULL THEN 'x; excluded due to no hit' ELSE 'x' END AS exclusion_criteria FROM orders LEFT JOIN b ON b.query = o_orderkey""")
def annotate_hits(t):
    kinds = t("supplier").select(F.col("s_suppkey").alias("accession"), F.when(F.col("s_suppkey") % 3 == 0, "exclusion_list").otherwise("reference").alias("kind"))
    matrix = t("orders").select(F.col("o_orderkey").alias("gi_number"), F.lit("0").alias("exclusion_status"), F.lit("x").alias("exclusion_criteria"))
    return quality.annotate_hits(matrix, t("orders").filter("o_orderkey % 5 != 0").select(F.col("o_orderkey").alias("header")), ranking.best_hit(_hits(t)), kinds)


@query("SELECT gi_number, CASE WHEN e IS NULL THEN '0' ELSE '1' END AS exclusion_status, coalesce(e, '') AS exclusion_criteria FROM (SELECT user_id AS gi_number, string_agg('In sequence ' || event_id, '; ' ORDER BY event_id) FILTER (event_type = 'click') AS e FROM events GROUP BY user_id)")
def annotate_failures(t):
    errors = t("events").select(F.col("user_id").alias("accession"), F.concat(F.when(F.col("event_type") == "click", "In sequence ").otherwise("other "), F.col("event_id").cast("string")).alias("errors"), F.col("event_id").alias("ord"))
    return quality.annotate_failures(t("events").select(F.col("user_id").alias("gi_number")).distinct(), errors)


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 != 0 OR c_mktsegment = 'reference'")
def drop_filtered(t):
    rows = t("customer").select("c_custkey", "c_mktsegment")
    return quality.drop_filtered(rows, rows.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("seq_name")), "c_custkey", "c_mktsegment")


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 'non IAV genomic sequence' WHEN p_partkey % 5 = 0 THEN 'not significant BLAST hit' ELSE '' END AS exclusion FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS p_size FROM part)")
def segment_exclusion(t):
    found = t("part").filter("p_partkey % 5 != 0").select(F.col("p_partkey").alias("query"), F.lit("r").alias("reference"), F.col("p_size").cast("string").alias("segment"))
    return quality.segment_exclusion(curation.with_segments(t("part").select("p_partkey"), found, "p_partkey"), 40).select("p_partkey", "exclusion")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) != 1 AND (d.lang != 'en' OR l.quality IS NULL OR l.quality != 1)")
def failed_validation(t):
    rows = t("documents").join(t("labels"), "doc_id", "left")
    flags = {"exclusion_status": F.coalesce("toxic", F.lit(0)).cast("string"), "collection_date_validated": F.when(F.col("lang") == "en", "Yes").otherwise("NA"), "country_validated": F.lit("4"), "host_validated": F.when(F.col("quality") == 1, "Yes").otherwise("NA")}
    return quality.failed_validation(rows.withColumns(flags)).select("doc_id")


@query("SELECT c_custkey, n_name AS cluster_90pct FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey != 2")
def with_clusters(t):
    members = t("customer").join(t("nation").filter("n_regionkey != 2"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("representative"), F.col("c_custkey").alias("member"), F.col("c_custkey").alias("ord"))
    return curation.with_clusters(t("customer").select("c_custkey"), members, 0.9, "c_custkey")


@query("""SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN '100' WHEN n_nationkey % 2 = 0 THEN n_nationkey::VARCHAR ELSE 'NA' END AS country_validated,
CASE WHEN n_regionkey = 1 THEN 'Country mapped from mapping file: ''' || n_name || ''' -> ''Mapped''' ELSE '' END AS note FROM nation""")
def standard_country(t):
    rows = t("nation").select("n_nationkey", F.concat(F.col("n_name"), F.lit(": somewhere")).alias("country"))
    codes = t("nation").filter("n_nationkey % 2 = 0 AND n_regionkey != 1").select(F.col("n_name").alias("display_name"), F.col("n_nationkey").cast("string").alias("m49_code"))
    codes = codes.union(t("region").filter("r_regionkey = 0").select(F.lit("Mapped"), F.lit("100")))
    names = t("nation").filter("n_regionkey = 1").select(F.col("n_name").alias("original"), F.lit("Mapped").alias("replacement"))
    return curation.standard_country(rows, codes, names).select("n_nationkey", "country_validated", F.col("_country_note").alias("note"))


@query("""SELECT n_nationkey, CASE WHEN n_regionkey IN (0, 2) THEN 'Yes' ELSE 'NA' END AS host_validated, CASE n_regionkey WHEN 0 THEN n_nationkey::VARCHAR WHEN 2 THEN '77' ELSE 'NA' END AS host_taxa_id,
CASE n_regionkey WHEN 0 THEN 'S' || n_nationkey WHEN 2 THEN 'NA' WHEN 3 THEN 'Bos taurus' ELSE 'NA' END AS host_scientific_name FROM nation""")
def standard_host(t):
    nation, key = t("nation"), F.col("n_nationkey")
    rows = nation.select("n_nationkey", F.concat(F.col("n_name"), F.lit(" (adult)")).alias("host"))
    names = nation.filter("n_regionkey = 0").select(F.lower("n_name").alias("name"), key.cast("string").alias("tax_id")).union(t("region").filter("r_regionkey = 0").select(F.lit("dog"), F.lit("77")))
    scientific = nation.filter("n_regionkey = 0").select(key.cast("string").alias("tax_id"), F.concat(F.lit("S"), key.cast("string")).alias("name"))
    mapping = nation.filter("n_regionkey IN (2, 3)").select(F.col("n_name").alias("original"), F.when(F.col("n_regionkey") == 2, "dog").otherwise("Bos taurus").alias("replacement"))
    return curation.standard_host(rows, names, scientific, mapping).select("n_nationkey", "host_validated", "host_taxa_id", "host_scientific_name")


@query("""SELECT c_custkey AS primary_accession, CASE WHEN c_custkey % 4 = 0 THEN 'CURATED' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 4 = 0 THEN 'fix; segment: ''' || c_mktsegment || ''' -> ''CURATED''' ELSE 'NA' END AS comment FROM customer""")
def overlay(t):
    matrix = t("customer").select(F.col("c_custkey").cast("string").alias("primary_accession"), F.col("c_mktsegment").alias("segment"), F.lit("NA").alias("comment"))
    curated = t("customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("primary_accession"), F.when(F.col("c_custkey") % 4 == 0, "CURATED").otherwise("n/a").alias("segment"), F.lit("fix").alias("comment"), F.col("c_custkey").alias("ord"))
    return curation.overlay(matrix, curated).withColumn("primary_accession", F.col("primary_accession").cast("bigint"))


@query("SELECT c_mktsegment AS segment, count(*) AS accessions, count(*) FILTER (h) AS in_tree, count(*) FILTER (NOT h) AS missing FROM (SELECT c_mktsegment, c_custkey IN (SELECT o_custkey FROM orders) AS h FROM customer) GROUP BY c_mktsegment")
def segment_completeness(t):
    return trees.segment_completeness(t("customer").select(F.col("c_custkey").alias("primary_accession"), F.col("c_mktsegment").alias("segment")), t("orders").select(F.col("o_custkey").alias("leaf")))


@query("WITH a AS (SELECT DISTINCT l_partkey AS x, l_suppkey AS y FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS x, l_suppkey AS y FROM lineitem WHERE l_returnflag = 'A') SELECT *, 'a' AS only_in FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'b' FROM (FROM b EXCEPT FROM a)")
def symmetric_difference(t):
    side = lambda flag: t("lineitem").filter(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"))
    return validation.symmetric_difference(side("R"), side("A"))


#: A master row of fifty columns with a gap in every fifth, and SQL for the columns of its positions.
MASTER = "AC-GT" * 10
COLUMNS = "list_filter(range(1, 51), lambda i: (i - 1) % 5 != 2)"


def _laid(t, name: str = "p_type") -> DataFrame:
    """Parts' types as rows of fifty columns, dealt out: one row group of a file may hold them all."""
    row = F.rpad(F.concat(F.lit("--"), F.replace(name, F.lit(" "), F.lit("-")), F.lit("-")), 50, "-")
    return dealt(t("part").select("p_partkey", row.alias("s")), "p_partkey", rows=100_000).withColumn("m", F.lit(MASTER))


LAID = "SELECT p_partkey, rpad('--' || replace(p_type, ' ', '-') || '-', 50, '-') AS s FROM part"


@query(f"SELECT p_partkey, printf('%.2f', 100.0 * len(list_filter(({COLUMNS})[3:14], lambda i: s[i:i] NOT IN ('-', 'N', 'n'))) / 12) AS coverage FROM ({LAID})")
def coverage(t):
    return _laid(t).select("p_partkey", sequence.coverage(F.col("m"), F.col("s"), F.lit("14"), F.lit("3")).alias("coverage"))


@query(f"SELECT p_partkey, list_min(p)::VARCHAR AS first, list_max(p)::VARCHAR AS last FROM (SELECT p_partkey, list_filter(range(1, 41), lambda n: s[({COLUMNS})[n]:({COLUMNS})[n]] != '-') AS p FROM ({LAID}))")
def covered_span(t):
    return _laid(t).select("p_partkey", sequence.covered_span("m", "s").alias("x")).select("p_partkey", "x.first", "x.last")


MOVED = "{0} - (length(s[:{0}]) - length(replace(s[:{0}], '-', ''))) + length(s) - length(ltrim(s, '-'))"
FEATURES = [(1, 8, "one"), (6, 20, "two"), (30, 40, "far")]
MOVED_SQL = f"SELECT DISTINCT p_partkey, s, {MOVED.format('a')} AS x, {MOVED.format('b')} AS y FROM ({LAID}), (VALUES {', '.join(f'({a}, {b})' for a, b, _ in FEATURES)}) AS f(a, b)"


@query(f"SELECT p_partkey, x AS start, y AS \"end\" FROM ({MOVED_SQL}) WHERE x != y")
def cds_coordinates(t):
    ranges = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b, _ in FEATURES))
    moved = sequence.cds_coordinates(sequence.gap_ranges(F.col("s")), ranges)
    return _laid(t).select("p_partkey", F.explode(moved).alias("r")).select("p_partkey", F.col("r.start").cast("bigint").alias("start"), F.col("r.end").cast("bigint").alias("end"))


SPAN = f"list_filter(range(1, 41), lambda n: s[({COLUMNS})[n]:({COLUMNS})[n]] != '-')"
KNOWN = f"printf('%.2f', 100.0 * len(list_filter(({COLUMNS})[a:b], lambda i: s[i:i] NOT IN ('-', 'N', 'n'))) / (b - a + 1))"


@query(f"""WITH f(a, b, product) AS (VALUES {', '.join(f"({a}, {b}, '{p}')" for a, b, p in FEATURES)}), l AS ({LAID} UNION ALL SELECT -1, '{MASTER}'),
mv AS (SELECT DISTINCT p_partkey, s, {MOVED.format('a')} AS x, {MOVED.format('b')} AS y FROM l, f), ok AS (FROM mv WHERE x != y),
hit AS (SELECT p_partkey, x, y, product, {KNOWN} AS cov FROM ok JOIN f ON y >= a AND x <= b),
bare AS (SELECT p_partkey FROM l WHERE p_partkey NOT IN (SELECT p_partkey FROM ok) UNION SELECT p_partkey FROM ok ANTI JOIN hit USING (p_partkey, x, y)),
o AS (SELECT p_partkey, x::VARCHAR AS cds_start, y::VARCHAR AS cds_end, product, cov FROM hit UNION SELECT p_partkey, 'NA', 'NA', 'NA', 'NA' FROM bare),
n AS (SELECT p_partkey, coalesce(list_min({SPAN})::VARCHAR, 'NA') AS aln_start, coalesce(list_max({SPAN})::VARCHAR, 'NA') AS aln_end FROM l)
SELECT CASE WHEN p_partkey < 0 THEN 'master' ELSE 'p' || p_partkey END AS accession, 'master' AS master_ref_accession, CASE WHEN p_partkey >= 0 AND p_partkey % 2 = 0 THEN 'r' || p_partkey % 3 ELSE 'master' END AS reference_accession,
aln_start, aln_end, cds_start, cds_end, product, cov AS genome_coverage FROM o JOIN n USING (p_partkey)""")
def feature_table(t):
    rows = _laid(t).select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("header"), F.col("s").alias("sequence"))
    master = t("region").filter("r_regionkey = 0").select(F.lit("master").alias("header"), F.lit(MASTER).alias("sequence"))
    features = t("region").filter("r_regionkey = 0").select(F.explode(F.array(*(F.struct(F.lit(a).alias("feature_start"), F.lit(b).alias("feature_end"), F.lit(p).alias("product")) for a, b, p in FEATURES))).alias("f")).select("f.*")
    key = F.col("p_partkey").cast("string")
    best = t("part").filter("p_partkey % 2 = 0").select(F.concat(F.lit("p"), key).alias("query"), F.concat(F.lit("r"), (F.col("p_partkey") % 3).cast("string")).alias("reference"))
    return alignment.feature_table(master.union(rows), "master", features, best)


MASTERS = {"m0": "-ACGT" * 10, "m2": "AC-GT" * 10, "m4": "ACGT-" * 10}
OWN_COLUMNS = "list_filter(range(1, 51), lambda i: (i - 1) % 5 != g)"
OWN_SPAN = f"list_filter(range(1, 41), lambda n: s[({OWN_COLUMNS})[n]:({OWN_COLUMNS})[n]] != '-')"


@query(f"""WITH f(a, b, product) AS (VALUES {', '.join(f"({a}, {b}, '{p}')" for a, b, p in FEATURES)}), v(g, m) AS (VALUES {', '.join(f"({name[1]}, '{row}')" for name, row in MASTERS.items())}),
l AS (SELECT 'p' || p_partkey AS id, 2 * (p_partkey % 3) AS g, s FROM ({LAID}) UNION ALL SELECT 'm' || g, g, m FROM v), o AS (SELECT g, a + g AS a, b + g AS b, product FROM f, v),
mv AS (SELECT DISTINCT id, g, s, {MOVED.format('a')} AS x, {MOVED.format('b')} AS y FROM l JOIN o USING (g)), ok AS (FROM mv WHERE x != y),
hit AS (SELECT id, g, x, y, product, printf('%.2f', 100.0 * len(list_filter(({OWN_COLUMNS})[a:b], lambda i: s[i:i] NOT IN ('-', 'N', 'n'))) / len(({OWN_COLUMNS})[a:b])) AS cov FROM ok JOIN o USING (g) WHERE y >= a AND x <= b),
bare AS (SELECT id FROM l WHERE id NOT IN (SELECT id FROM ok) UNION SELECT id FROM ok ANTI JOIN hit USING (id, x, y)),
r AS (SELECT id, x::VARCHAR AS cds_start, y::VARCHAR AS cds_end, product, cov FROM hit UNION SELECT id, 'NA', 'NA', 'NA', 'NA' FROM bare)
SELECT id AS accession, 'm' || g AS master_ref_accession, 'm' || g AS reference_accession, coalesce(list_min({OWN_SPAN})::VARCHAR, 'NA') AS aln_start, coalesce(list_max({OWN_SPAN})::VARCHAR, 'NA') AS aln_end,
cds_start, cds_end, product, cov AS genome_coverage FROM r JOIN l USING (id)""")
def feature_tables(t):
    """The alignments of three masters, each with its own annotation, in one call."""
    spark = t("part").sparkSession
    masters = spark.createDataFrame([(name, name, row) for name, row in MASTERS.items()], "master string, header string, sequence string")
    key = F.col("p_partkey")
    rows = _laid(t).select(F.concat(F.lit("m"), (2 * (key % 3)).cast("string")).alias("master"), F.concat(F.lit("p"), key.cast("string")).alias("header"), F.col("s").alias("sequence"))
    features = spark.createDataFrame([(name, a + int(name[1]), b + int(name[1]), p) for name in MASTERS for a, b, p in FEATURES], "master string, feature_start int, feature_end int, product string")
    return alignment.feature_tables(masters.unionByName(rows), features, spark.createDataFrame([], "query string, reference string"))


@query("SELECT p_partkey, p_type[:3] || p_type[5:8] || p_type[10:] AS cut FROM part")
def trim_ranges(t):
    return t("part").select("p_partkey", sequence.trimmed(F.col("p_type"), ":3,5:8,10:").alias("cut"))


@query("SELECT o_orderkey, 'ORD' || o_orderkey AS base, (o_orderkey % 9)::INTEGER AS version FROM orders")
def accession_parts(t):
    acc = F.concat(F.lit(" ORD"), F.col("o_orderkey").cast("string"), F.lit("."), (F.col("o_orderkey") % 9).cast("string"))
    return t("orders").select("o_orderkey", text.accession_base(acc).alias("base"), text.accession_version(acc).alias("version"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN p_size::VARCHAR WHEN 2 THEN p_size::VARCHAR ELSE NULL END AS segment FROM part")
def segment_number(t):
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    key = F.when(kind == 0, F.col("p_partkey").cast("string")).when(kind == 1, F.concat(F.lit("refset_"), size, F.lit("_aln"))).when(kind == 2, F.concat(F.lit("SEG-"), size)).otherwise("abc")
    return t("part").select("p_partkey", text.segment_number(key).alias("segment"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'one; ' || p_name ELSE 'one; ' || p_name || '; new' END AS comment FROM part")
def append_item(t):
    comment = F.concat(F.lit("one;"), F.col("p_name"))
    return t("part").select("p_partkey", text.append_item(comment, F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("  "), F.upper("p_name"))).otherwise("new ")).alias("comment"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_custkey END AS n FROM customer")
def nullable_integer(t):
    kind = F.col("c_custkey") % 3
    shown = F.when(kind == 0, " n/a ").when(kind == 1, F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(".0"))).otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(".5")))
    return t("customer").select("c_custkey", blanks.nullable_integer(shown).alias("n"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'alignment_filtering: bad' WHEN 'view' THEN 'alignment_filtering: filtered against reference ' || user_id ELSE 'alignment_filtering' END AS reason FROM events")
def filtering_reason(t):
    kind = F.col("event_type")
    return t("events").select("event_id", text.filtering_reason(F.when(kind == "click", "bad ").otherwise(""), F.when(kind == "view", F.col("user_id").cast("string"))).alias("reason"))


@query("SELECT n_nationkey, split_part('Peru:' || n_name, ':', 1) AS country, ' ' || n_name AS locality, n_name AS host FROM nation")
def place_and_host(t):
    place = F.concat(F.lit("Peru: "), F.col("n_name"), F.lit(":x"))
    return t("nation").select("n_nationkey", text.country_part(place).alias("country"), text.locality_part(place).alias("locality"), text.host_name(F.concat(F.lit(" "), F.col("n_name"), F.lit(" (young) (x)"))).alias("host"))


@query("SELECT r_name AS name, s AS source FROM (SELECT r_name, CASE WHEN r_regionkey % 2 = 0 THEN 'iqtree' ELSE 'other' END AS s FROM region) ORDER BY s, name LIMIT 1")
def canonical_tree(t):
    return ranking.canonical_tree(t("region").select(F.col("r_name").alias("name"), F.when(F.col("r_regionkey") % 2 == 0, "iqtree").otherwise("other").alias("source")))


@query("SELECT n_regionkey AS tax_id, coalesce(max_by(n_name, n_nationkey) FILTER (n_nationkey % 3 = 0), min_by(n_name, n_nationkey) FILTER (n_nationkey % 3 = 1)) AS common_name FROM nation WHERE n_nationkey % 3 < 2 GROUP BY n_regionkey")
def common_names(t):
    kind = F.col("n_nationkey") % 3
    return ranking.common_names(t("nation").select(F.col("n_regionkey").alias("tax_id"), F.col("n_name").alias("name"), F.when(kind == 0, "genbank common name").when(kind == 1, "common name").otherwise("synonym").alias("name_class"), F.col("n_nationkey").alias("ord")))


@query("SELECT 'customer' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def row_counts(t):
    return validation.row_counts({name: t(name) for name in ("customer", "orders")})


@query("SELECT count(*) AS rows, count(*) FILTER (c_custkey % 2 = 0) AS changed, 0::BIGINT AS filled, count(*) FILTER (c_custkey % 2 = 0) AS mapped_unknown FROM customer")
def run_counters(t):
    before = t("customer").select("c_custkey", "c_mktsegment")
    after = before.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "unknown").otherwise(F.col("c_mktsegment")))
    return validation.run_counters(before, after, "c_custkey", "c_mktsegment")


@query(f"WITH b AS ({BEST}) SELECT reference, count(*) AS queries FROM b GROUP BY reference")
def grouped_queries(t):
    return alignment.grouped_queries(ranking.best_hit(_hits(t)), "reference")


@query("SELECT c_custkey AS primary_accession FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_custkey % 5 != 0")
def new_accessions(t):
    ids = t("customer").select(F.col("c_custkey").alias("primary_accession"))
    return alignment.new_accessions(ids, t("orders").select(F.col("o_custkey").alias("header")), ids.filter("primary_accession % 5 = 0").select(F.col("primary_accession").alias("header")))


@query("SELECT c_custkey AS header, c_name AS sequence FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def sequences_of(t):
    return alignment.sequences_of(t("orders").select(F.col("o_custkey").alias("accession")), t("customer").select(F.col("c_custkey").alias("header"), F.col("c_name").alias("sequence")))


@query("SELECT min(event_id) AS event_id, user_id FROM events GROUP BY user_id")
def first_before_bar(t):
    rows = t("events").select("event_id", "user_id", F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("header"))
    return ranking.first_before_bar(rows, "event_id").select("event_id", "user_id")


@query("SELECT count(DISTINCT lang) AS segments FROM documents WHERE trim(lang) != ''")
def segment_count(t):
    return trees.segment_count(t("documents"), "lang")


@query("SELECT doc_id::VARCHAR AS primary_accession, CASE WHEN lang = 'en' THEN 'Yes' ELSE 'NA' END AS collection_date_validated, 'Yes' AS host_validated, '4' AS country_validated, '' AS host, '' AS host_scientific_name, coalesce(source, '') AS country, '' AS collection_date FROM documents WHERE lang IS DISTINCT FROM 'en'")
def failed_report(t):
    flags = {"primary_accession": F.col("doc_id").cast("string"), "exclusion_status": F.lit("0"), "collection_date_validated": F.when(F.col("lang") == "en", "Yes").otherwise("NA"), "country_validated": F.lit("4"), "host_validated": F.lit("Yes"), "country": F.coalesce("source", F.lit(""))}
    return quality.failed_report(t("documents").select("doc_id", "lang", "source").withColumns(flags))


LAYOUT = "array_to_string(list_transform(range(1, length(ref) + 1), lambda i: CASE WHEN ref[i:i] = '-' THEN '-' ELSE coalesce(nullif(q[length(replace(ref[:i], '-', '')):length(replace(ref[:i], '-', ''))], ''), '-') END), '')"


@query(f"SELECT 'C' || c_custkey AS header, {LAYOUT} AS sequence, 1 AS is_query FROM (SELECT c_custkey, c_mktsegment AS q, replace(n_name, 'A', '-') AS ref FROM customer JOIN nation ON n_nationkey = c_nationkey) UNION ALL SELECT n_nationkey || '.1', replace(n_name, 'A', '-'), 0 FROM nation")
def merged_alignment(t):
    refs = t("nation").select(F.concat(F.col("n_nationkey").cast("string"), F.lit(".1")).alias("header"), F.replace("n_name", F.lit("A"), F.lit("-")).alias("sequence"), F.col("n_nationkey").cast("bigint").alias("ord"))
    queries = t("customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("header"), F.col("c_mktsegment").alias("sequence"), F.col("c_nationkey").cast("string").alias("reference"), F.col("c_custkey").alias("ord"))
    return alignment.merged_alignment(refs, queries).select("header", "sequence", "is_query")


@query("SELECT c_name AS sequence_id, coalesce('b' || c_custkey, 'own') AS alignment_name, c_mktsegment AS alignment, CASE WHEN c_custkey % 3 = 0 THEN 'ins' ELSE '' END AS insertion FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_name, 'own', c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN 'ins' ELSE '' END FROM customer WHERE c_custkey % 2 != 0")
def alignment_rows(t):
    people = t("customer").withColumn("header", F.col("c_name"))
    rows = people.select("header", F.col("c_mktsegment").alias("sequence"), F.lit("own").alias("reference"), F.col("c_custkey").alias("ord"))
    best = people.filter("c_custkey % 2 = 0").select(F.col("header").alias("query"), F.concat(F.lit("b"), F.col("c_custkey").cast("string")).alias("reference"))
    found = alignment.alignment_rows(rows, best, people.filter("c_custkey % 3 = 0").select(F.col("header").alias("accession"), F.lit("ins").alias("insertion")))
    return found.select("sequence_id", "alignment_name", "alignment", "insertion")


@query("SELECT 'S' || p_partkey AS accession, 'CDS' AS category, p_size AS start, p_size + 10 AS \"end\", CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS gene_name, p_brand AS symbol FROM part WHERE p_partkey % 3 != 0")
def gene_table(t):
    even = F.col("p_partkey") % 2 == 0
    notes = F.when(even, F.create_map(F.lit("product"), F.col("p_name"), F.lit("gene"), F.col("p_brand"))).otherwise(F.create_map(F.lit("protein"), F.col("p_brand"), F.lit("locus_tag"), F.col("p_brand")))
    gff = t("part").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string"), F.lit(".2 x")).alias("seqid"), F.when(F.col("p_partkey") % 3 == 0, "gene").otherwise("CDS").alias("type"), F.col("p_size").alias("start"), (F.col("p_size") + 10).alias("end"), notes.alias("attributes"))
    return alignment.gene_table(gff)


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 != 0 OR c_custkey % 3 = 0")
def split_excluded(t):
    rows = t("customer").select("c_custkey", F.col("c_name").alias("primary_accession"), F.when(F.col("c_custkey") % 4 == 0, "bad").otherwise(" ").alias("exclusion"), F.when(F.col("c_custkey") % 3 == 0, "Reference").otherwise("query").alias("accession_type"))
    return quality.split_excluded(rows)[0].select("c_custkey")


@query("SELECT p_partkey, p_partkey % 4 < 3 AS flag FROM part")
def unverified(t):
    key = F.col("p_partkey") % 4
    return t("part").select("p_partkey", quality.unverified(F.when(key == 0, F.concat(F.col("p_name"), F.lit(" unverified"))).otherwise(F.col("p_name")), F.array(F.when(key == 1, "x Unverified").otherwise("y")), F.when(key == 2, "we were unable to verify it")).alias("flag"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || '; new  remark' ELSE 'only' END AS comment FROM part")
def append_unless_inside(t):
    key = F.col("p_partkey") % 3
    comment = F.when(key < 2, F.concat(F.col("p_name"), F.lit("; "))).otherwise(" ")
    return t("part").select("p_partkey", text.append_unless_inside(comment, F.when(key == 0, F.upper("p_name")).when(key == 1, " new  remark ").otherwise("only")).alias("comment"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(t):
    return batches.tumbling_counts(t("events")).withColumn("total", F.round("total", 4))


@query("""SELECT user_id AS seq_name, min_by(event_type, event_id) AS error FROM events WHERE event_type = 'click' GROUP BY user_id
UNION ALL SELECT c_custkey, '' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'click')""")
def collect_filtered(t):
    errors = t("events").select(F.col("user_id").alias("accession"), F.lit("r").alias("reference"), F.when(F.col("event_type") == "click", "click").otherwise("").alias("errors"), F.lit("").alias("warnings"), F.struct(F.lit("f").alias("file"), F.col("event_id").alias("line")).alias("ord"))
    lost = t("customer").select(F.col("c_custkey").alias("seq_name"), F.lit("r").alias("reference"))
    return curation.collect_filtered(errors, lost).select("seq_name", "error")


@query("""WITH n AS (SELECT n_regionkey AS id, n_name AS name, n_nationkey AS o, CASE n_nationkey % 3 WHEN 0 THEN 'genbank common name' WHEN 1 THEN 'scientific name' ELSE 'synonym' END AS class FROM nation),
c AS (SELECT id, max_by(name, o) AS common_name FROM n WHERE class = 'genbank common name' GROUP BY id), w AS (SELECT r_regionkey AS id FROM region UNION ALL SELECT 99)
SELECT w.id AS taxa_id, coalesce(name, 'Unknown') AS name, CASE class WHEN 'scientific name' THEN 'scientific' WHEN 'genbank common name' THEN 'generic' ELSE 'other' END AS name_type, r_name AS taxonomy_level, common_name
FROM w LEFT JOIN n USING (id) LEFT JOIN c USING (id) LEFT JOIN region ON r_regionkey = w.id""")
def taxa_names(t):
    kind = F.col("n_nationkey") % 3
    names = t("nation").select(F.col("n_regionkey").alias("tax_id"), F.col("n_name").alias("name"), F.when(kind == 0, "genbank common name").when(kind == 1, "scientific name").otherwise("synonym").alias("name_class"), F.col("n_nationkey").alias("ord"))
    ids = t("region").select(F.col("r_regionkey").cast("bigint").alias("tax_id"))
    wanted = ids.union(ids.filter("tax_id = 0").select(F.lit(99).cast("bigint")))
    return taxonomy.taxa_names(wanted, names, t("region").select(F.col("r_regionkey").alias("tax_id"), F.lit(None).cast("bigint").alias("parent_tax_id"), F.col("r_name").alias("rank")))


@query("SELECT name, segment FROM (SELECT DISTINCT p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 'K' || p_partkey ELSE '' END AS k, CASE WHEN p_partkey % 2 = 0 THEN 'S' || p_partkey ELSE p_size::VARCHAR END AS segment FROM part)")
def tree_table(t):
    even = F.col("p_partkey") % 2 == 0
    sources = t("part").select(F.col("p_name").alias("name"), *(F.lit("x").alias(c) for c in ("source", "tree_type", "tree_model", "newick", "created_at", "description")), F.when(even, F.concat(F.lit("K"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("seg_"), F.col("p_size").cast("string"))).alias("segment_key"))
    segments = t("part").filter(even).select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("accession"), F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("segment"))
    return trees.tree_table(sources, segments).select("name", "segment")


@query("SELECT CASE WHEN event_type = 'click' THEN 'failed' ELSE 'unprojectable' END AS kind, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def filtering_summary(t):
    rows = t("events").select(F.col("user_id").alias("seq_name"), F.when(F.col("event_type") == "click", "bad").otherwise("").alias("error"))
    return validation.filtering_summary(rows).select("kind", "n")


@query("SELECT 'leaf without metadata' AS problem, o_custkey AS id FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 7 = 0) UNION ALL SELECT 'metadata without leaf', c_custkey FROM customer WHERE c_custkey % 7 != 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def check_tree(t):
    people = t("customer").select(F.col("c_custkey").alias("primary_accession"))
    return trees.check_tree(t("orders").select(F.col("o_custkey").alias("leaf")), people.filter("primary_accession % 7 != 0"), people.select(F.col("primary_accession").alias("header")))


@query("SELECT DISTINCT trim(lang) AS lang FROM documents WHERE trim(lang) != ''")
def distinct_values(t):
    return validation.distinct_values(t("documents"), "lang")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS EPA_major_clade, CASE WHEN c_custkey % 3 = 0 THEN 'm' || c_custkey ELSE '' END AS EPA_minor_clade FROM customer")
def with_placements(t):
    key = F.col("c_custkey").cast("string")
    found = lambda cond, name: t("customer").filter(cond).select(key.alias("key"), name.alias("best"), name.alias("names"), F.lit("1").alias("weights"))
    rows = t("customer").select("c_custkey", F.concat(key, F.lit(".1")).alias("primary_accession"))
    return curation.with_placements(rows, found("c_custkey % 2 = 0", F.col("c_mktsegment")), found("c_custkey % 3 = 0", F.concat(F.lit("m"), key))).select("c_custkey", "EPA_major_clade", "EPA_minor_clade")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 2 = 1")
def orphans(t):
    queries = t("orders").select(F.col("o_orderkey").cast("string").alias("header"), F.col("o_custkey").cast("string").alias("reference"))
    refs = t("customer").filter("c_custkey % 2 = 0").select(F.concat(F.col("c_custkey").cast("string"), F.lit(".2")).alias("header"))
    found = alignment.orphans(queries, refs)
    return found.select(F.col("seq_name").cast("bigint").alias("o_orderkey"), F.col("reference").cast("bigint").alias("o_custkey"))


@query(f"SELECT p_partkey, {LAYOUT} AS row FROM (SELECT p_partkey, p_name AS q, replace(p_type, ' ', '-') AS ref FROM part)")
def project_gaps(t):
    """Names laid out in the columns of types."""
    return t("part").select("p_partkey", sequence.projected(F.replace("p_type", F.lit(" "), F.lit("-")), F.col("p_name")).alias("row"))


@query("SELECT n_regionkey, replace(n_name, ' ', '_') AS leaf FROM nation")
def tree_leaves(t):
    rows = t("nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.replace("n_name", F.lit(" "), F.lit("_")))), ",").alias("x"))
    return trees.leaves(rows.select("n_regionkey", F.concat(F.lit("("), "x", F.lit(");")).alias("newick")))


OTHER = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE CAST(c_custkey % 3 AS STRING) END"


@query(f"""WITH l AS (SELECT c_nationkey AS pair, c_custkey AS leaf, c_mktsegment AS a, {OTHER} AS b FROM customer), n AS (SELECT pair, count(*) AS shared FROM l GROUP BY pair),
s AS (SELECT pair, 'a' AS side, list_sort(list(leaf)) AS leaves FROM l GROUP BY pair, a UNION ALL SELECT pair, 'b', list_sort(list(leaf)) FROM l GROUP BY pair, b),
c AS (SELECT pair, leaves, bool_or(side = 'a')::INT AS in_a, bool_or(side = 'b')::INT AS in_b FROM s JOIN n USING (pair) WHERE shared >= 4 AND len(leaves) >= 2 AND shared - len(leaves) >= 2 GROUP BY pair, leaves)
SELECT pair, shared::INTEGER AS shared_taxa, coalesce(sum(in_a), 0)::INTEGER AS splits_a, coalesce(sum(in_b), 0)::INTEGER AS splits_b, coalesce(sum((in_a + in_b = 1)::INT), 0)::INTEGER AS rf, max(CASE WHEN shared >= 4 THEN 2 * (shared - 3) ELSE 0 END)::INTEGER AS max_rf,
CASE WHEN shared >= 4 THEN coalesce(sum((in_a + in_b = 1)::INT), 0) / (2.0 * (shared - 3)) ELSE 0 END::DOUBLE AS normalized_rf, 0 AS unique_to_a, 0 AS unique_to_b FROM n LEFT JOIN c USING (pair) GROUP BY pair, shared""")
def tree_distance(t):
    """A nation's customers as two trees, by market segment and by another rule; halves may not occur twice, as the leaves' order is theirs."""
    def grown(by: str, side: str) -> DataFrame:
        groups = t("customer").groupBy("c_nationkey", F.expr(by).alias("g")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("c_custkey")).cast("array<string>"), ","), F.lit(")")).alias("x"))
        return groups.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("x")).select(F.concat(F.lit(side), F.col("c_nationkey").cast("string")).alias("tree"), F.concat(F.lit("("), "x", F.lit(");")).alias("newick"))

    pairs = t("customer").select(F.col("c_nationkey").alias("pair")).distinct().select("pair", *(F.concat(F.lit(side), F.col("pair").cast("string")).alias(side) for side in "ab"))
    return trees.tree_distances(pairs, grown("c_mktsegment", "a").unionByName(grown(OTHER, "b")), canonical_halves=True)


OLD_TREES = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_brand END AS name, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS tree_name, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS newick, CAST(p_size % 10 AS STRING) AS chromosome, p_size % 4 AS segment_number FROM {}"


@query(f"""WITH o AS (SELECT p_partkey, coalesce(nullif(trim(name), ''), nullif(trim(tree_name), ''), 'tree_dir_tree') AS name, chromosome AS segment_key, segment_number::VARCHAR AS segment, trim(newick) AS newick FROM ({OLD_TREES.format('part')}) WHERE trim(newick) != '')
SELECT name, 'tree_dir' AS source, segment_key, segment, newick FROM o WHERE (name, segment_key, segment) NOT IN (SELECT p_brand, CAST(p_size % 10 AS STRING), '1' FROM part) QUALIFY row_number() OVER (PARTITION BY name, segment_key, segment ORDER BY p_partkey) = 1""")
def migrated_trees(t):
    old = t("part").sparkSession.sql(OLD_TREES.format("{part}"), part=t("part"))
    held = t("part").select(F.col("p_brand").alias("name"), F.lit("tree_dir").alias("source"), (F.col("p_size") % 10).cast("string").alias("segment_key"), F.lit("1").alias("segment"))
    return trees.migrated_trees(old, held, datetime(2024, 1, 1), "p_partkey").select("name", "source", "segment_key", "segment", "newick")


@query()
def longest_frame(t):
    return t("documents").select("doc_id", sequence.longest_frame(F.regexp_replace(F.upper("text"), "[^ACGT]", "")).alias("x")).select("doc_id", "x.frame", "x.start", "x.protein")
