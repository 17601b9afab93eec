"""Messages and articles over conversations, documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions import text
from beaconlake.operators import articles, messages
from beaconlake.plans.tables import query, table

POLLED_SQL = """m AS (
  SELECT turn AS poll_id, CASE WHEN role = 'system' THEN 'bbc' ELSE 'tg_c' || conv_id END AS source,
         1710760000 + (conv_id * 7919) % 86400 AS date, conv_id * 1000 + turn AS seq FROM conversations)"""


@query("message_feed", f"""WITH {POLLED_SQL}, t AS (SELECT * FROM m WHERE source LIKE 'tg\\_%' ESCAPE '\\')
, p AS (
SELECT poll_id, source, date, seq, 'new' AS part FROM t WHERE poll_id = (SELECT max(poll_id) FROM t)
UNION ALL (SELECT poll_id, source, date, seq, 'old' FROM t WHERE poll_id < (SELECT max(poll_id) FROM t)
           ORDER BY poll_id DESC, source, date, seq LIMIT 100))
SELECT *, row_number() OVER (ORDER BY poll_id DESC, source, date, seq) AS place FROM p""")
def message_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    rows = c.select(
        F.col("turn").alias("poll_id"),
        F.when(F.col("role") == "system", "bbc").otherwise(F.concat(F.lit("tg_c"), F.col("conv_id").cast("string"))).alias("source"),
        (F.lit(1710760000) + F.col("conv_id") * 7919 % 86400).alias("date"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"),
    )
    return messages.rolling_feed(rows, place="place")


@query("message_cards", """
WITH d AS (SELECT doc_id, source || CASE WHEN lang = 'fr' THEN '_abu' ELSE '' END AS channel, (doc_id * 7919) % 86400 AS date,
                  replace(CASE WHEN lang = 'de' THEN '12 שלום ' || text WHEN lang = 'es' THEN '\\nA\\n' || text ELSE text END, '\\n', chr(10)) AS body,
                  CASE WHEN lang = 'de' THEN '12 שלום ' || text WHEN lang = 'es' THEN '\\nA\\n' || text ELSE text END AS text
           FROM documents)
SELECT doc_id, strftime(make_timestamp(date * 1000000), '%H:%M:%S') AS shown_time, contains(lower(channel), 'abu') AS highlight,
       CASE WHEN coalesce(unicode(regexp_extract(text, '\\p{L}')) BETWEEN 1424 AND 1791, FALSE) THEN 'rtl' ELSE 'ltr' END AS direction,
       CASE WHEN instr(body, chr(10)) > 0 THEN substr(body, 1, instr(body, chr(10)) - 1) END AS title,
       CASE WHEN instr(body, chr(10)) > 0 THEN substr(body, instr(body, chr(10)) + 1) ELSE body END AS body
FROM d""")
def message_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    shown = F.when(lang == "de", F.concat(F.lit("12 שלום "), "text")).when(
        lang == "es", F.concat(F.lit("\\nA\\n"), "text")
    ).otherwise(F.col("text"))
    rows = d.select(
        "doc_id", F.concat("source", F.when(lang == "fr", "_abu").otherwise("")).alias("channel"),
        (F.col("doc_id") * 7919 % 86400).alias("date"), shown.alias("text"),
    )
    return messages.cards(rows).select("doc_id", "shown_time", "highlight", "direction", "title", "body")


SMILE = "\U0001f600 "


def linked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with link spans on their first two words; assistant turns start with a character of two UTF-16 units."""
    c = table(spark, sf_dir, "conversations")
    words = F.split("text", " ")
    prefix = F.when(F.col("role") == "assistant", SMILE).otherwise("")
    start = F.when(F.col("role") == "assistant", 3).otherwise(0)
    first, second = F.length(words[0]), F.length(F.get(words, 1))

    def span(kind: str, offset, length, url) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), offset.cast("int").alias("offset"), length.cast("int").alias("length"), url.alias("url"))

    spans = F.array(
        span("text_url", start, first, F.concat(F.lit("https://t.example.com/"), F.col("conv_id").cast("string"))),
        span("bold", start, first, F.lit(None).cast("string")),
        span("url", start + first + 1, second, F.lit(None).cast("string")),
        span("text_url", F.lit(10000000), F.lit(5), F.lit("https://beyond.example.com")),
    )
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.col("turn").alias("message_id"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("channel"), F.concat(prefix, F.col("text")).alias("text"),
        spans.alias("spans"), (F.lit(1710760000) + F.col("turn")).alias("date"), F.lit("").alias("media"),
    )


LINKED_SQL = f"""w AS (
  SELECT *, string_split(text, ' ') AS words, CASE WHEN role = 'assistant' THEN '{SMILE}' ELSE '' END AS prefix FROM conversations),
t AS (
  SELECT conv_id, turn, conv_id * 1000 + turn AS seq,
         prefix || '{text.LINK_OPEN[0]}https://t.example.com/' || conv_id || '{text.LINK_OPEN[1]}' || words[1] || '{text.LINK_CLOSE}' ||
         CASE WHEN len(words) > 1 THEN ' {text.LINK_OPEN[0]}' || CASE WHEN words[2] LIKE 'http%' THEN '' ELSE 'https://' END || words[2] ||
              '{text.LINK_OPEN[1]}' || words[2] || '{text.LINK_CLOSE}' || substr(text, length(words[1]) + length(words[2]) + 2)
              ELSE '' END AS text
  FROM w)"""


@query("message_markup", f"WITH {LINKED_SQL} SELECT seq, text FROM t")
def message_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linked_messages(spark, sf_dir)
    return rows.select("seq", text.link_markup(F.col("text"), F.col("spans")).alias("text"))


@query("message_json", f"""WITH {LINKED_SQL}
SELECT seq, CAST(to_json({{'message_id': turn, 'channel': 'c' || conv_id, 'text': text, 'date': 1710760000 + turn, 'media': ''}}) AS VARCHAR) AS payload
FROM t""")
def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.records(linked_messages(spark, sf_dir)).select("seq", "payload")


@query("snake_names", r"""
WITH n AS (SELECT p_partkey, lower(substr(p_name, 1, 1)) || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) || p_type || 'Id' AS name FROM part)
SELECT p_partkey, name, upper(regexp_replace(name, '([^A-Z])([A-Z])', '\1_\2', 'g')) AS snake FROM n""")
def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.split("p_name", " ")[1]
    name = F.concat(F.lower(F.substring("p_name", 1, 1)), F.initcap(second), "p_type", F.lit("Id"))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return rows.withColumn("snake", text.upper_snake(F.col("name")))


# Paragraphs in SQL without look-ahead: boundaries become marks to split at.
_BLOCKS = "|".join(articles.BLOCKS.replace(" p ", " ").split())
_PARENTS = "|".join(articles.PARENTS.split())
ARTICLE_SQL = f"""v AS (
  SELECT page_id, url, regexp_replace(html, '<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->', '', 'gsi') AS visible FROM pages),
b AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(visible, '<p(\\s[^>]*)?>', chr(1) || 'P', 'gi'),
         '</(?:{_PARENTS})\\s*>|<(?:{_BLOCKS})(?:[\\s/][^>]*)?>', chr(1) || 'X', 'gi'), chr(1)) AS parts FROM v),
a AS (
  SELECT page_id, url, coalesce(nullif(array_to_string(list_filter(list_transform(list_filter(parts, lambda x: x[1] = 'P'),
         lambda x: trim(replace(replace(replace(replace(replace(replace(regexp_replace(substr(x, 2), '<[^>]*>', '', 'g'),
           '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13))),
         lambda x: strlen(x) > 30), chr(10) || chr(10)), ''), '{articles.NOTICE}') AS article
  FROM b)"""


@query("article_text", f"WITH {ARTICLE_SQL} SELECT url, article FROM a")
def article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.articles(table(spark, sf_dir, "pages"))


@query("article_tree", f"WITH {ARTICLE_SQL} SELECT url, article FROM a")
def article_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.articles(table(spark, sf_dir, "pages"), tree=True)


@query("news_with_text", f"""WITH {ARTICLE_SQL},
n AS (SELECT doc_id, CASE WHEN lang <> 'de' THEN 'Doc ' || doc_id END AS title,
             CASE WHEN lang <> 'es' THEN coalesce(url, 'https://nowhere.example.com/' || doc_id) END AS link,
             CASE WHEN lang <> 'fr' THEN source END AS published
      FROM documents LEFT JOIN pages ON page_id = doc_id)
SELECT doc_id, coalesce(title, 'No Title') AS title, coalesce(link, '#') AS link, coalesce(published, 'Unknown Date') AS published,
       coalesce(article, '{articles.NOTICE}') AS article
FROM n LEFT JOIN a ON a.url = n.link""")
def news_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    docs = table(spark, sf_dir, "documents").join(pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    lang, key = F.col("lang"), F.col("doc_id").cast("string")
    news = docs.select(
        "doc_id", F.when(lang != "de", F.concat(F.lit("Doc "), key)).alias("title"),
        F.when(lang != "es", F.coalesce("url", F.concat(F.lit("https://nowhere.example.com/"), key))).alias("link"),
        F.when(lang != "fr", F.col("source")).alias("pubDate"),
    )
    earlier = pages.withColumns({"page_id": F.col("page_id") - 1_000_000, "html": F.lit("<p>an earlier version of the page that nobody should see</p>")})
    return articles.news_with_text(news, pages.unionByName(earlier)).select("doc_id", "title", "link", "published", "article")
