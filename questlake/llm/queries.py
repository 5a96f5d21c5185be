"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.llm.common import LOWER, UPPER
from questlake.llm.decontaminate import contamination
from questlake.llm.exact_dedup import exact_dedup
from questlake.llm.jaccard_join import near_duplicates
from questlake.llm.license_scan import TEMPLATES, TERM, THRESHOLD, TRIGGER, scan_licenses
from questlake.llm.mixing import mix
from questlake.llm.phrases import collocations
from questlake.llm.pii import KINDS, find_personal_data
from questlake.llm.quality import fit_quality, held_out, score_quality
from questlake.llm.quality_rules import apply_rules, fit_rules
from questlake.llm.registry import QUERIES, query, table  # noqa: F401
from questlake.llm.resample import resample
from questlake.llm.sharding import read_shards, shuffle_to_files
from questlake.llm.substring_dedup import remove_repeats
from questlake.llm.url_filter import judge_captures, url_keys
from questlake.session import new_dir

_PLAIN_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op1_decontaminate",
    f"""WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
  i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS n
        FROM (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
  windows AS (SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS g
              FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
  starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
             FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
  grams AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g FROM starts),
  found AS (SELECT doc_id, n, p, item FROM grams JOIN windows USING (n, g)),
  hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
           FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM found) GROUP BY 1),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query(
    "op2_exact_dedup",
    r"""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "rate", "copies")


@query("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "shards")
    shuffle_to_files(table(spark, sf_dir, "documents"), path)
    text = F.coalesce("text", F.lit(""))
    return read_shards(spark, path, 8).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, table(spark, sf_dir, "labels")))
    score = F.col("quality_score")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


@query(
    "op7_jaccard_join",
    r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS p FROM d)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) GROUP BY 1, 2),
  links AS (SELECT x, y FROM common JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 90 * (a.n + b.n - c)),
  reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY 1) USING (doc_id)""",
)
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query(
    "op4_substring_dedup",
    r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  windows AS (SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
  lost AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q
           FROM (SELECT doc_id, p, doc_id > min(doc_id) OVER (PARTITION BY g) AS later FROM windows) WHERE later),
  words AS (SELECT doc_id, q, w[q] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM d)),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n FROM words ANTI JOIN lost USING (doc_id, q) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 4)
    return found.select("doc_id", *[number(k) for k in range(4)], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


_CAPTURES_SQL = r"""c AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 730 AS INTEGER) AS day_,
    lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1), ':[0-9]*$', '')) AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)', 1), '/'), lambda p: p <> '') AS parts FROM pages),
  k AS (SELECT page_id, day_, list_distinct(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[:i], '/')))) AS keys FROM c WHERE host <> ''),
  e AS (SELECT page_id, day_, unnest(keys) AS key FROM k),
  s AS (SELECT key, min(page_id) * 31 % 730 AS first, count(*) AS n FROM e GROUP BY 1)"""


@query(
    "op3_url_filter",
    f"""WITH {_CAPTURES_SQL},
  days AS (SELECT CASE WHEN contains(key, '/') THEN 'paths' ELSE 'domains' END AS list, key,
             DATE '2024-01-01' + CAST(first AS INTEGER) AS a, DATE '2024-01-01' + CAST(first + n % 90 + 1 AS INTEGER) AS b,
             DATE '2024-01-01' + CAST(first + 200 AS INTEGER) AS d FROM s),
  spans AS (SELECT list, key, a AS since, b AS until FROM days UNION ALL SELECT list, key, d, NULL FROM days),
  met AS (SELECT page_id, count(*) AS n_entries, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
          FROM e JOIN spans USING (key) WHERE since <= day_ AND (until IS NULL OR until > day_) GROUP BY 1)
SELECT page_id, coalesce(n_entries, 0) AS n_entries, coalesce(lists, '') AS lists, coalesce(n_entries, 0) > 0 AS blocked
FROM pages LEFT JOIN met USING (page_id)""",
)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key of the pages' URLs is listed on a day, taken off up to 90 days later and listed for good
    after 200; fetch days and list days follow from ids and counts, as the tables hold no dates of captures."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    captures = table(spark, sf_dir, "pages").select("page_id", "url", day(F.col("page_id") * 7919 % 730).alias("fetched"))
    keys = captures.select("page_id", F.explode(url_keys(F.col("url"))).alias("key")).groupBy("key")
    keys = keys.agg((F.min("page_id") * 31 % 730).alias("first"), F.count(F.lit(1)).alias("n"))
    history = [(F.col("first"), True), (F.col("first") + F.col("n") % 90 + 1, False), (F.col("first") + 200, True)]
    list_name = F.when(F.contains("key", F.lit("/")), "paths").otherwise("domains")
    entries = keys.select("key", list_name.alias("list"), F.inline(F.array(*[F.struct(day(d).alias("since"), F.lit(on).alias("listed")) for d, on in history])))
    judged = judge_captures(captures, entries)
    return judged.select(F.col("capture_id").alias("page_id"), "n_entries", F.array_join("lists", ",").alias("lists"), "blocked")


_TEMPLATES_SQL = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
_TERMS_SQL = rf"regexp_extract_all(translate({{}}, '{UPPER}', '{LOWER}'), '{TERM}')"


@query(
    "op5_license_scan",
    rf"""WITH RECURSIVE t(license, template) AS (VALUES {_TEMPLATES_SQL}),
  f AS (SELECT doc_id, source || '/' || CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE-' || doc_id
          WHEN doc_id % 100 = 0 THEN (doc_id // 1000) || '/LICENSE-' || doc_id
          WHEN doc_id % 10 = 0 THEN (doc_id // 1000) || '/' || (doc_id // 100 % 10) || '/LICENSE-' || doc_id
          ELSE (doc_id // 1000) || '/' || (doc_id // 100 % 10) || '/' || doc_id || '.txt' END AS path, text FROM documents),
  h AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(list_distinct(string_split(coalesce(text, ''), chr(10)))) AS line FROM f)
        WHERE regexp_matches(line, '{TRIGGER}')),
  l AS (SELECT line, count(*) AS times FROM h GROUP BY 1),
  w AS (SELECT line, times, term, count(*) AS c FROM (SELECT line, times, unnest({_TERMS_SQL.format("line")}) AS term FROM l) GROUP BY ALL),
  df AS (SELECT term, sum(times) AS df FROM w GROUP BY 1),
  total AS (SELECT sum(times) AS n FROM l),
  tw AS (SELECT license, term, c * (ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0) AS x FROM (SELECT license, term, count(*) AS c
         FROM (SELECT license, unnest({_TERMS_SQL.format("template")}) AS term FROM t) GROUP BY ALL) LEFT JOIN df USING (term), total),
  tn AS (SELECT license, sqrt(sum(x * x)) AS norm FROM tw GROUP BY 1),
  lw AS (SELECT line, term, c * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS x FROM w JOIN df USING (term), total),
  ln_ AS (SELECT line, sqrt(sum(x * x)) AS norm FROM lw GROUP BY 1),
  cos AS (SELECT line, license, sum(lw.x * tw.x / tn.norm) / any_value(ln_.norm) AS score
          FROM lw JOIN tw USING (term) JOIN tn USING (license) JOIN ln_ USING (line) GROUP BY ALL),
  m AS (SELECT line, license, score FROM cos WHERE score >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY line ORDER BY round(score, 9) DESC, license) = 1),
  own AS (SELECT doc_id, license, score FROM h JOIN m USING (line)
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, license) = 1),
  dirs AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, license FROM own JOIN f USING (doc_id) WHERE contains(path, '/LICENSE-')
           QUALIFY row_number() OVER (PARTITION BY dir ORDER BY round(score, 9) DESC, license) = 1),
  near AS (SELECT doc_id, dir, dirs.license FROM f JOIN dirs ON starts_with(path, dir || '/')
           QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len(dir) DESC) = 1)
SELECT f.doc_id, own.license AS own_license, round(own.score, 6) AS score, coalesce(own.license, near.license) AS license,
  CASE WHEN own.license IS NULL THEN near.dir END AS inherited_from
FROM f LEFT JOIN own USING (doc_id) LEFT JOIN near USING (doc_id)""",
)
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a tree with a directory per thousand and hundred ids, in which
    every tenth id is a license file, every hundredth that of the directory above, and so on."""
    name, thousand, hundred = F.col("doc_id").cast("string"), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100) % 10
    license_name = F.concat(F.lit("LICENSE-"), name)
    below = (
        F.when(F.col("doc_id") % 1000 == 0, license_name)
        .when(F.col("doc_id") % 100 == 0, F.concat_ws("/", thousand, license_name))
        .when(F.col("doc_id") % 10 == 0, F.concat_ws("/", thousand, hundred, license_name))
        .otherwise(F.concat_ws("/", thousand, hundred, F.concat(name, F.lit(".txt"))))
    )
    files = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat("source", F.lit("/"), below).alias("path"))
    templates = spark.createDataFrame(TEMPLATES, "license string, template string")
    scanned = scan_licenses(files, templates)
    return scanned.select(F.col("file_id").alias("doc_id"), F.col("own").alias("own_license"), F.round("score", 6).alias("score"), "license", "inherited_from")


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_rules(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


#: CRC-32 by a table of 256 entries over the bytes of a text's hexadecimal form.
_CRC_SQL = """t AS (SELECT list_transform(range(256), lambda k: list_reduce(list_prepend(k, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
  b AS (SELECT f, list_transform(range(1, len(x), 2), lambda i: strpos('0123456789ABCDEF', x[i]) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 17) AS bytes
        FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM g))),
  k AS (SELECT f, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, v: xor(c >> 8, crcs[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket FROM b, t)"""


@query(
    "op11_resample",
    rf"""WITH w AS (SELECT 'd' AS part, doc_id AS id, {_PLAIN_WORDS} AS w FROM documents UNION ALL SELECT 'b', item_id, {_PLAIN_WORDS} FROM benchmark),
  g AS (SELECT part, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w),
  {_CRC_SQL},
  n AS (SELECT part, id, bucket, count(*) AS n FROM g JOIN k USING (f) GROUP BY ALL),
  s AS (SELECT bucket, sum(n) FILTER (part = 'd') AS s, sum(n) FILTER (part = 'b') AS t FROM n GROUP BY 1),
  a AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM s),
  gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000)::DOUBLE
             / ((coalesce(s, 0) + 1.0::DOUBLE) * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s, a),
  o AS (SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total FROM n JOIN gain USING (bucket) WHERE part = 'd' GROUP BY 1),
  r AS (SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
          CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
          CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN o ON id = doc_id WHERE part = 'd'),
  v AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
  x AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM v WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * able // 100 THEN rank END AS rank FROM v LEFT JOIN x USING (doc_id)""",
)
def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op12_phrases",
    r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
  s AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
  f AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, any_value(w[i : i + m - 1]) AS words, count(*) AS f FROM s GROUP BY 1, 2 HAVING count(*) >= 30),
  k AS (SELECT lang, phrase, words, f AS a, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1),
  c AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM k
        JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[:k], ' ')
        JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k + 1 :], ' ')),
  b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  subs AS (SELECT lang, f, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS m) WHERE len(words) > m),
  around AS (SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(f) AS longer FROM subs GROUP BY 1, 2),
  kept AS (SELECT b.* FROM b LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
