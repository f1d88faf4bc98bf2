"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.llm import (bottom_k, centroids, chat_format, language_id, license_scan, mixing,
                           nearest, ngram_join, packing, prefix_trie, toxicity, url_filter, warc)
from clickstar.llm.tables import Scratch, read, ship
from clickstar.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(ship(prepare(spark)), sf_dir)

        QUERIES[name] = run
        return run

    return register


@query("op1_packing")
def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs)


@query("op2_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    mixed = mixing.mix(docs, Scratch(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", F.col("target").cast("double"),
                        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


@query("op3_license_scan")
def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return license_scan.report(license_scan.scan(docs))


@query("op4_ngram_join")
def ngram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.near_duplicates(docs, Scratch(spark, "ngrams"), width=3, percent=90,
                                      keyed=False)


@query("op5_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.grade(docs, model)


@query("op6_warc")
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.archive_and_index(pages, Scratch(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "index_pos")


# Rules as keys, host and path in one.
BLOCKED = ["net/", "example.com/de/"]
ALLOWED = ["example.net/en/", "org/fr/"]
# Hosts with one of these words between dots or hyphens are listed.
SPAM_WORDS = ("casino", "pills", "bets", "loans", "ads")
SPAM_HOST = r"(^|[.-])(" + "|".join(SPAM_WORDS) + r")([.-]|$)"


@query("op7_url_filter")
def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge(pages, BLOCKED, ALLOWED,
                            lambda hosts: hosts.where(F.col("host").rlike(SPAM_HOST)),
                            Scratch(spark, "urls"))


HOST_SQL = r"""translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
SQL["op7_url_filter"] = rf"""
WITH u AS (SELECT page_id, {HOST_SQL} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
        THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
        THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '{SPAM_HOST}') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op8_bottom_k")
def sketch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    both = bottom_k.edited(docs, Scratch(spark, "sketches"))
    seen = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       "sketch", bottom_k.sketch(F.col("edited")).alias("edited_sketch"),
                       "next_sketch")
    return seen.select(
        "doc_id", "n_chars", "edited_sha256", bottom_k.as_text(F.col("sketch")).alias("fingerprint"),
        bottom_k.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        bottom_k.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        bottom_k.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@query("op9_nearest")
def nearest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest.nearest(vectors, F.col("vec_id") % 20 == 0)


@query("op10_chat_format")
def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    typed = turns.unionByName(extra).select(
        "conv_id", "turn", "role",
        chat_format.parts_of(F.coalesce("text", F.lit(""))).alias("parts"))
    formatted = chat_format.conversations(chat_format.format_turns(typed))
    back = chat_format.read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "expanded_tokens")


SQL["op10_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text) + length('<turn ></turn>') + 1
    + 2 * (length(role) + length(text)) - length(replace(replace(replace(role || text,
        '\', ''), '<', ''), '>', '')) - length(role || text) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS expanded_tokens
FROM e GROUP BY conv_id"""


def filled_sql(rows: str, group: str, total: str) -> str:
    """Shares of ``rows`` (mass, lim, ord): the last row that is not full by itself sets the level."""
    by = f"PARTITION BY {group} " if group else ""
    order = f"{by}ORDER BY lim / mass, ord"
    return f"""
    SELECT * EXCLUDE (rest, opened), CASE WHEN rest * mass > lim * opened THEN lim
        ELSE coalesce(first_value(CASE WHEN rest * mass <= lim * opened THEN rest END IGNORE NULLS)
                OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) * mass
            / first_value(CASE WHEN rest * mass <= lim * opened THEN opened END IGNORE NULLS)
                OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS share
    FROM (SELECT *, {total} - coalesce(sum(lim) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0) AS rest,
        sum(mass) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS opened
        FROM ({rows}))"""


SQL["op2_mixing"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(source, '') AS s, source IS NULL AS no_source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents),
sized AS (SELECT *, CASE WHEN size >= {mixing.PREFERENCE[0][0]} THEN 0
        WHEN size >= {mixing.PREFERENCE[1][0]} THEN 1 WHEN size >= 1 THEN 2 END AS class,
    (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null-' || size)), 1, 12)
        AS BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u FROM d),
src AS (SELECT no_source, s, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (ORDER BY no_source, s) AS ord FROM src),
tgt AS ({filled_sql('''SELECT *, CAST([3, 1, 2][(ord - 1) % 3 + 1] AS DOUBLE) AS mass,
    source_size * 2.0::DOUBLE AS lim, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS everything
    FROM ranked''', '', 'everything')}),
cls AS ({filled_sql('''SELECT c.no_source, c.s, c.class, class_size, t.share AS target, c.class AS ord,
        class_size * CAST([4, 3, 2][c.class + 1] AS DOUBLE) AS mass, class_size * 2.0::DOUBLE AS lim
    FROM (SELECT no_source, s, class, CAST(sum(size) AS DOUBLE) AS class_size FROM sized
        WHERE class IS NOT NULL GROUP BY ALL) c JOIN tgt t USING (no_source, s)''',
    'no_source, s', 'target')}),
per AS (SELECT *, floor(share / class_size + 1e-9) AS whole, CASE WHEN greatest(0.0, share / class_size
        - floor(share / class_size + 1e-9)) > 1e-9
    THEN share / class_size - floor(share / class_size + 1e-9) ELSE 0 END AS p FROM cls),
need AS (SELECT no_source, s, sum(p * class_size) AS words FROM per GROUP BY ALL),
odds AS (SELECT z.*, coalesce(whole, 0) AS whole, CASE WHEN p > 0
        THEN (u / (1 - u)) / (p / (1 - p)) END AS rank, words
    FROM sized z LEFT JOIN per USING (no_source, s, class) LEFT JOIN need USING (no_source, s)),
upto AS (SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (
    PARTITION BY no_source, s ORDER BY rank NULLS LAST, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM odds)
SELECT doc_id, size, source_size, share AS target, CAST((whole + CASE WHEN rank IS NOT NULL AND (
        upto < words OR upto - size < words AND upto - size / 2 <= words)
    THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM upto JOIN tgt USING (no_source, s)"""


WORDS_SQL = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), [])"""
SQL["op4_ngram_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s
    FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS MATERIALIZED (SELECT doc_id, unnest(s) AS t FROM s),
e AS MATERIALIZED (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
        FROM u a JOIN u b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL)
    JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM n
    UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(reached) AS component_id
FROM r JOIN n USING (doc_id) GROUP BY doc_id"""

SQL["op6_warc"] = rf"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url FROM pages),
k AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
    max(page_id) OVER (PARTITION BY html) AS first, array_to_string(list_reverse(string_split(
        lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '.')), ',') || ')'
        || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS url_key,
    (page_id % {warc.CIRCLE} + {warc.CIRCLE}) % {warc.CIRCLE} AS seconds FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN first END AS refers_to,
    row_number() OVER (ORDER BY url_key, seconds, page_id) - 1 AS index_pos FROM k"""

SQL["op9_nearest"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
        AND len([e FOR e IN embedding IF e <> 0]) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
    AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20"""


@query("op12_language_id")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language_id.predict(docs, language_id.fit(docs.where(~language_id.is_held_out())))


@query("op13_prefix_trie")
def trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.trie(prefix_trie.rebuilt(turns), Scratch(spark, "trie"))


# crc32 of a short text, bit by bit.
CRC_SQL = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda s: CAST(ascii(s) AS BIGINT)), lambda state, byte: list_reduce(
            [xor(state, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda crc, bit: xor(crc >> 1,
                CAST(3988292384 AS BIGINT) * (crc & 1))), CAST(4294967295 AS BIGINT)),
        CAST(4294967295 AS BIGINT))"""
SQL["op13_prefix_trie"] = f"""
WITH t AS (SELECT conv_id, length(coalesce(text, '')) AS chars, md5(length(coalesce(role, ''))
        || ':' || coalesce(role, '') || coalesce(text, '')) AS id, turn, coalesce(role, '') AS role
    FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, role, id) AS ids,
    list(chars ORDER BY turn NULLS FIRST, role, id) AS chars FROM t GROUP BY conv_id),
h AS (SELECT *, {CRC_SQL} % 6 AS h FROM o),
c AS (SELECT h.conv_id, coalesce(b.ids[:h.h], []) || h.ids[h.h + 1:] AS ids,
    coalesce(b.chars[:h.h], []) || h.chars[h.h + 1:] AS chars
    FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS MATERIALIZED (SELECT conv_id, len(ids) AS full_depth, unnest(range(len(ids) + 1)) AS depth,
    array_to_string(ids[:depth], '') AS node, array_to_string(ids[:depth - 1], '') AS up,
    coalesce(chars[depth], 0) AS chars FROM c),
n AS MATERIALIZED (SELECT depth, node, CASE WHEN depth > 0 THEN any_value(up) END AS up,
    min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
        FILTER (depth = full_depth), '')) AS ends_sha256 FROM p GROUP BY depth, node),
k AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
s AS (SELECT p.depth, p.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves,
    sum((n.n_convs - 1) * n.chars) AS saved_tokens
    FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth
    LEFT JOIN k ON k.depth = n.depth AND k.node = n.node GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs,
    coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
    n.ends_sha256
FROM n JOIN s USING (depth, node) LEFT JOIN k USING (depth, node)
    LEFT JOIN n u ON u.depth = n.depth - 1 AND u.node = n.up"""


@query("op11_centroids")
def centroid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.whole_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    state, final = centroids.cluster(vectors, Scratch(spark, "centroids"))
    return centroids.report(state, final).drop("evaluated")


def clustering_sql(rounds: int) -> str:
    """Full search in every round, in whole numbers."""
    steps = ["""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v)]) = 0),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * c) AS BIGINT) FOR c IN x] AS x,
    FROM e),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')), x) - 1
    AS cluster, x FROM v QUALIFY cluster < 16)"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (SELECT r, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
    min({{'d': CAST(list_inner_product(CAST(v.x AS DOUBLE[]), CAST(v.x AS DOUBLE[]))
        - 2 * list_inner_product(CAST(v.x AS DOUBLE[]), CAST(c.x AS DOUBLE[]))
        + list_inner_product(CAST(c.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT),
        'c': c.cluster}}) AS near FROM v CROSS JOIN c{n} c GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (SELECT near.c AS cluster, i, sum(x[i]) AS s, count(*) AS n
    FROM a{n}, range(1, 65) t(i) GROUP BY ALL),
n{n} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
    FROM m{n} GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(n.x, c.x) AS x
    FROM c{n} c LEFT JOIN n{n} n USING (cluster))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance,
    CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.near.c"""


SQL["op11_centroids"] = clustering_sql(3)
