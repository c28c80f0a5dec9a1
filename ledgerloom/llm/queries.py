"""Registered queries of the operators in this folder, and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    html_blocks, hyperminhash, packing, periodic, personal, pivots, positional, reputation, secret_scan, substrings,
    toxicity, warc_bundles, whitening,
)
from ledgerloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_html_main_text")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract_main_text(table(spark, folder, "pages"))


# The fixed rules of the URL filter.
URL_RULES = (
    reputation.Rule("block", "net", "/"),
    reputation.Rule("allow", "example.net", "/en/"),
    reputation.Rule("block", "example.com", "/de/"),
    reputation.Rule("allow", "org", "/fr/"),
)
_DOCUMENT_NUMBER = r"/([0-9]+)(?:/|[.]html)?$"


def _shrunk(source: str, parent: str, on: str, out: str) -> str:
    """SQL of one level: prior weight by moments, clamped, then the shrunk share."""
    joined = f"(SELECT c.*, p.mean FROM {source} c JOIN {parent} p ON {on})"
    return f"""{out} AS (SELECT j.*, w.weight, (bad + weight * mean) / (n + weight) AS share FROM {joined} j,
  (SELECT greatest(1.0, least(1000.0, CASE WHEN room > 0 AND over / room > 0 THEN 1 / (over / room) - 1
     ELSE 1000.0 END)) AS weight FROM (SELECT sum(pow(bad - n * mean, 2) - n * mean * (1 - mean)) AS over,
     sum(n * (n - 1) * mean * (1 - mean)) AS room FROM {joined})) w)"""


OP3_SQL = f"""WITH cut AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
outcomes AS (
  SELECT page_id, count(*) AS n, count(*) FILTER (WHERE coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad
  FROM (SELECT DISTINCT page_id, try_cast(regexp_extract(path, '{_DOCUMENT_NUMBER}', 1) AS BIGINT) AS d FROM cut
        WHERE page_id IS NOT NULL)
  JOIN labels ON doc_id = d WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
bare AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', '', 's'), '(:[0-9]*)?\\.*$', '') AS b FROM cut),
labelled AS (
  SELECT *, string_split(b, '.') AS l, regexp_full_match(b, '[0-9]+(\\.[0-9]+){{3}}') OR starts_with(b, '[') AS number,
    list_aggregate(string_split(b, '.')[-2:], 'string_agg', '.') IN ({", ".join(f"'{s}'" for s in reputation.PUBLIC_SUFFIXES)}) AS listed
  FROM bare),
hosts AS (
  SELECT host, any_value(CASE WHEN number THEN b ELSE list_aggregate(l[CASE WHEN listed THEN -3 ELSE -2 END:], 'string_agg', '.') END) AS domain,
    any_value(CASE WHEN number THEN '' WHEN listed THEN list_aggregate(l[-2:], 'string_agg', '.') ELSE l[-1] END) AS suffix,
    sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
  FROM labelled JOIN outcomes USING (page_id) GROUP BY 1),
every AS (SELECT sum(bad) / sum(n) AS mean FROM hosts),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1),
{_shrunk("suffixes", "every", "true", "suffix_shares")},
suffix_means AS (SELECT suffix, share AS mean FROM suffix_shares),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
{_shrunk("domains", "suffix_means", "c.suffix = p.suffix", "domain_shares")},
domain_means AS (SELECT domain, share AS mean FROM domain_shares),
{_shrunk("hosts", "domain_means", "c.domain = p.domain", "host_shares")},
ruled AS (
  SELECT cut.*, CASE
    WHEN (cut.host = 'example.net' OR cut.host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (cut.host = 'example.com' OR cut.host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (cut.host = 'org' OR cut.host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (cut.host = 'net' OR cut.host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    coalesce(share - 1.645 * sqrt(share * (1 - share) / (n + weight + 1)) > 0.25, false) AS poor,
    coalesce(n, 0)::BIGINT AS n_labelled
  FROM cut LEFT JOIN host_shares ON cut.host = host_shares.host)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow' WHEN poor THEN 'block' ELSE 'allow' END AS verdict, n_labelled
FROM ruled"""


@query("op3_host_reputation", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the label of the document whose number ends its path: bad if poor or toxic."""
    pages = table(spark, folder, "pages")
    numbered = pages.select("page_id", reputation.path_of(F.col("url")).alias("path")).selectExpr(
        "page_id", f"try_cast(regexp_extract(path, '{_DOCUMENT_NUMBER}', 1) AS BIGINT) AS doc_id")
    labels = table(spark, folder, "labels").where("quality IS NOT NULL OR toxic IS NOT NULL").selectExpr(
        "doc_id", "coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS bad")
    outcomes = numbered.distinct().join(labels, "doc_id").select("page_id", "bad")
    return reputation.judge_urls(pages, outcomes, URL_RULES, scratch_path(spark, "reputation")).drop("bad_share", "bad_bound")


OP6_SQL = """WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    sha256(coalesce(html, '')) AS k FROM pages),
kept AS (SELECT k, max(page_id) AS last_id FROM payloads WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM payloads LEFT JOIN kept ON payloads.k = kept.k AND payload_bytes >= 1000"""


@query("op6_warc_bundles", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "warc")
    index = warc_bundles.write_bundles(table(spark, folder, "pages"), target)
    return warc_bundles.read_bundles(spark, index, target, payloads=False).drop("url", "payload")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


CLOSING_ID = 2


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path(), CLOSING_ID)


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP4_SQL = f"""WITH docs AS (SELECT doc_id, regexp_extract_all({_SMALL}, '{_ALNUM}') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_SMALL}, '{_ALNUM}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[k:k + 12], ' ') AS window, least(len(w), 13) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS window
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM docs, sizes)),
matches AS (SELECT doc_id, item, k, p.size FROM places p JOIN windows s ON p.window = s.window AND p.size = s.size),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM matches) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM matches) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op4_positional_index", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = positional.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                                     scratch_path(spark, "positional"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"[^\x20\x09-\x0D]+"
OP7_SQL = f"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
windows AS (
  SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM docs)),
firsts AS (SELECT gram, min(doc_id) AS least FROM windows GROUP BY 1),
late AS (SELECT doc_id, k FROM windows JOIN firsts USING (gram) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS place FROM late),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs)
  ANTI JOIN gone USING (doc_id, place) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


@query("op7_repeated_passages", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SECRET_RULES = secret_scan.BASE_RULES + secret_scan.MORE_RULES


def _sql_spans(rule: secret_scan.Rule, number: int) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, length(j[i]) >= {rule.least} AS ok,
  list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT
    + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS b, length(m[i]) AS size
FROM (SELECT doc_id, m, j, gaps, unnest(range(1, len(m) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(t, {pattern}, 0) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS j,
    string_split_regex(t, {pattern}) AS gaps FROM texts))"""


OP9_SQL = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS (SELECT *, kind || ':' || b || ':' || (b + size) AS span FROM ({
    " UNION ALL ".join(_sql_spans(rule, k) for k, rule in enumerate(SECRET_RULES))}) WHERE ok),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY b, number) FILTER (WHERE base) AS base,
    string_agg(span, ',' ORDER BY b, number) AS spans FROM spans GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN sums USING (doc_id)"""


@query("op9_secret_scan", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"), scratch_path(spark, "secrets"), SECRET_RULES)
    n = {kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")  # noqa: B023
         for kind in ("assign", "access", "hex")}
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *n.values(), F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
                        secret_scan.spans_text(F.col("spans")).alias("spans"))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def toxicity_model(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """A model from the labelled documents that are not held out."""
    return toxicity.train(docs, labels.where(~held_out()), scratch_path(spark, "toxicity"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity_model(spark, docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


OP5_SQL = f"""WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_SMALL}, '{_WORDS}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
sets AS (SELECT doc_id, n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS digest
  FROM shingles JOIN sizes USING (doc_id) GROUP BY 1, 2),
reps AS (SELECT digest, min(doc_id) AS rep, any_value(n) AS n FROM sets GROUP BY 1),
own AS (SELECT rep, n, gram FROM shingles JOIN reps ON doc_id = rep),
pairs AS (
  SELECT a.rep AS u, b.rep AS v FROM own a JOIN own b ON a.gram = b.gram AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT rep AS node, rep AS least FROM reps
  UNION SELECT v, least FROM reach JOIN pairs ON node = u WHERE least < v),
found AS (SELECT node, min(least) AS least FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(f.least, d.doc_id) AS component_id,
  coalesce(f.least, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sets s USING (doc_id) LEFT JOIN reps r USING (digest) LEFT JOIN found f ON f.node = r.rep"""


@query("op5_hyperminhash", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), scratch_path(spark, "hyperminhash"), 85)


OP2_SQL = """WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS node, vec_id AS least FROM embeddings
  UNION SELECT v, least FROM reach JOIN links ON node = u WHERE least < v),
found AS (SELECT node, min(least) AS least FROM reach GROUP BY 1),
n AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least AS component_id, least = vec_id AS kept
FROM embeddings JOIN found ON node = vec_id LEFT JOIN n ON u = vec_id"""


@query("op2_pivot_permutation", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_vectors(table(spark, folder, "embeddings"), scratch_path(spark, "pivots"))


# The SQL finds runs without suffixes: equal five-word windows q words apart, in unbroken stretches of places.
OP11_SQL = f"""WITH given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS v, list_reduce([4294967295] || flatten(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS r
  FROM documents),
placed AS (SELECT doc_id, v, len(v)::BIGINT AS n, xor(r, 4294967295) % 10 AS kind, xor(r, 4294967295) // 10 AS g FROM given),
told AS (SELECT *, g % greatest(n, 1) AS a FROM placed),
docs AS (
  SELECT doc_id, n, CASE WHEN kind = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN v[i + 1]
    ELSE v[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE v END AS w FROM told),
grams AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS gram
  FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM docs)),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b
  ON a.doc_id = b.doc_id AND a.gram = b.gram AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches
  WHERE length >= 6 AND length >= 4 * q GROUP BY 1, 2, 3),
told_runs AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS best FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS place FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS place FROM docs) ANTI JOIN gone USING (doc_id, place) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
  best.p::BIGINT AS period, (1000 * best.l // best.p)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN told_runs USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query("op11_periodic_runs", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth document by the checksum of its id gets a tail that repeats its own words."""
    docs = table(spark, folder, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    split = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
    tailed = docs.selectExpr(
        "*", f"CASE WHEN h % 10 = 0 THEN {split} ELSE cast(array() AS array<string>) END AS v", "floor(h / 10) AS g",
    ).selectExpr("*", "size(v) AS n", "cast(g % nullif(size(v), 0) AS int) AS a").selectExpr(
        "*", "1 + cast(floor((n - a) / (3 + g % 8)) AS int) AS p").selectExpr(
        "doc_id", """CASE WHEN a IS NULL THEN text ELSE array_join(
            transform(sequence(0, n - 1), i -> v[if(i < a, i, a + (i - a) % p)]), ' ') END AS text""")
    found = periodic.periodic_runs(tailed)
    listed = "concat(r.start, ',', r.length, ',', r.period, chr(10))"
    best = "array_min(transform(runs, r -> struct(-r.length AS size, r.start AS start, r.period AS period)))"
    return found.selectExpr(
        "doc_id", "cast(size(runs) AS bigint) AS n_runs", f"{best} AS best",
        f"sha2(array_join(transform(runs, r -> {listed}), ''), 256) AS runs_sha256",
        "sha2(collapsed_text, 256) AS collapsed_sha256",
    ).selectExpr("doc_id", "n_runs", "best.start AS start", "-best.size AS length", "best.period AS period",
                 "1000 * -best.size div best.period AS exponent_milli", "runs_sha256", "collapsed_sha256")


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The contract asks for rows of components only, so a vector without any has none here."""
    return whitening.whiten(table(spark, folder, "embeddings"), scratch_path(spark, "whitening")).where("component IS NOT NULL")


@query("op13_personal_data")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find_personal(table(spark, folder, "documents"), scratch_path(spark, "personal"))
    n = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")  # noqa: B023
         for kind in personal.KINDS]
    base = F.filter("spans", lambda s: s["kind"] != personal.FOUND)
    return found.select("doc_id", *n, F.sha2(personal.spans_text(base), 256).alias("base_sha256"),
                        personal.spans_text(F.col("spans")).alias("spans"))
