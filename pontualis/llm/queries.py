"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.llm import (
    audit,
    chats,
    decontaminate,
    exact,
    jaccard,
    language,
    lines,
    mixing,
    phrases,
    secrets,
    sharding,
    toxicity,
    wrappers,
)
from pontualis.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_exact_dedup(spark, folder):
    out = exact.groups(table(spark, folder, "documents"), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.col("sha").alias("text_sha256"))


ORACLE["op2_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op5_mixing(spark, folder):
    out = mixing.mix(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE["op5_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM sources
), levels AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY source_size / weight, rank
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
         sum(weight) OVER (ORDER BY source_size / weight, rank
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighed
), marked AS (
  SELECT *, cap * rest <= weight * (total - earlier) AS clamped FROM levels
), targets AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN CAST(cap AS DOUBLE)
              ELSE weight * (total - coalesce(sum(cap) FILTER (clamped) OVER (), 0))
                   / sum(weight) FILTER (NOT clamped) OVER () END AS target
  FROM marked
), placed AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT)
              ELSE 0 END AS whole,
         CAST(floor(target + 0.5) AS BIGINT) AS words,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + least(size, greatest(0, words - whole * source_size - before))
            AS BIGINT) AS taken
FROM placed
"""


@query
def op8_sharding(spark, folder):
    out = sharding.into_shards(table(spark, folder, "documents"), 8)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    apart = F.coalesce(language.held_out("doc_id"), F.lit(False))
    model = language.train(docs.filter(~apart))
    out = language.identify(docs.select("doc_id", "text"), model, "answer")
    return out.select("doc_id", apart.alias("held_out"), F.col("answer.lang").alias("lang_pred"),
                      "answer.score")


@query
def op10_decontamination(spark, folder):
    out = decontaminate.matches(table(spark, folder, "documents"),
                                table(spark, folder, "benchmark"))
    listed = F.array_join(F.array_sort("items"), ",")
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(listed, 256).alias("items_sha256"),
                      decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))
                      .alias("contaminated"))


@query
def op3_jaccard_join(spark, folder):
    out = jaccard.near_duplicates(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op6_secrets(spark, folder):
    out = secrets.secrets(table(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return out.select(F.col("id").alias("doc_id"), count("assign").alias("n_assign"),
                      count("access").alias("n_access"), count("hex").alias("n_hex"),
                      F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                      secrets.listed(F.col("spans")).alias("spans"))


@query
def op1_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = toxicity.train(docs.filter(~apart), labels.filter(~apart))
    out = toxicity.score(docs.select("doc_id", "text"), model, "answer")
    return out.select("doc_id", apart.alias("held_out"), F.col("answer.score").alias("score"),
                      (F.col("answer.score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_html_extraction(spark, folder):
    out, _ = wrappers.extract(table(spark, folder, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text",
                      F.char_length("text").cast("long").alias("n_chars"))


@query
def op9_line_dedup(spark, folder):
    out = lines.dedup_lines(table(spark, folder, "documents"))
    return out.select(F.col("id").alias("doc_id"),
                      F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long")
                      .alias("n_lines"),
                      F.size("deleted").cast("long").alias("n_deleted"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


# Five lines hold five words at least, so longer runs are unions of stretches of five.
ORACLE["op9_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, text, unnest(parts) AS line, generate_subscripts(parts, 1) AS number
  FROM split
), wordy AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY number) AS pos
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), stretches AS (
  SELECT doc_id, pos, n,
         array_agg(line) OVER ahead AS run,
         sum(words) OVER ahead AS words,
         count(*) OVER ahead AS size
  FROM wordy, (VALUES (1), (2), (3), (4), (5)) AS t(n)
  WINDOW ahead AS (PARTITION BY doc_id, n ORDER BY pos
                   ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
), later AS (
  SELECT doc_id, pos, n, words FROM stretches WHERE size = n
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT w.doc_id, w.number
  FROM wordy w JOIN later l ON w.doc_id = l.doc_id AND w.pos BETWEEN l.pos AND l.pos + l.n - 1
  WHERE l.words >= 5
), joined AS (
  SELECT n.doc_id, n.number, n.line, g.number IS NOT NULL AS deleted
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.number = g.number
)
SELECT d.doc_id, coalesce(len(any_value(d.parts)), 0) AS n_lines,
       count(*) FILTER (j.deleted) AS n_deleted,
       sha256(coalesce(string_agg(j.line, chr(10) ORDER BY j.number) FILTER (NOT j.deleted), ''))
         AS text_sha256
FROM split d LEFT JOIN joined j ON d.doc_id = j.doc_id
GROUP BY d.doc_id
"""


@query
def op11_chat_format(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    # Every row opens a turn of its own.
    log = turns.unionByName(probe).select("conv_id", F.col("turn").alias("message"),
                                          F.lit(0).alias("seq"), F.lit("open").alias("kind"),
                                          "role", "text")
    return chats.digests(chats.read_back(chats.format_chats(log)))


# In the formatted text a turn has its two marks around role and text, and a backslash more for
# every backslash and control string; these may overlap, so each is counted by itself.
ORACLE["op11_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, * FROM (VALUES (0, 'user', '\### Assistant: </turn> ok'),
                            (1, 'assistant', '\### Assistant: </turn> ok'))
), sized AS (
  SELECT *, length('<turn ' || '>' || chr(10) || chr(10) || '</turn>' || chr(10))
            + length(role) + length(text)
            + list_sum([(length(s) - length(replace(s, mark, ''))) // length(mark)
                        FOR mark IN ['\', '<turn ', '</turn>', '>' || chr(10), '### System:',
                                     '### User:', '### Assistant:', '<|im_start|>', '<|im_end|>']])
              AS chars
  FROM (SELECT *, role || chr(0) || text AS s FROM turns)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op12_collocations(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


ORACLE["op12_collocations"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents
), pieces AS (
  SELECT doc, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS total FROM worded GROUP BY lang
), numbered AS (
  SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS i
  FROM (SELECT row_number() OVER () AS piece, * FROM worded)
), runs AS (
  SELECT lang, w1, w1 || ' ' || lead(w1, 1) OVER own AS w2,
         w1 || ' ' || lead(w1, 1) OVER own || ' ' || lead(w1, 2) OVER own AS w3,
         w1 || ' ' || lead(w1, 1) OVER own || ' ' || lead(w1, 2) OVER own || ' '
            || lead(w1, 3) OVER own AS w4,
         w1 || ' ' || lead(w1, 1) OVER own || ' ' || lead(w1, 2) OVER own || ' '
            || lead(w1, 3) OVER own || ' ' || lead(w1, 4) OVER own AS w5
  FROM numbered WINDOW own AS (PARTITION BY piece ORDER BY i)
), counts AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, unnest([1, 2, 3, 4, 5]) AS k, unnest([w1, w2, w3, w4, w5]) AS phrase FROM runs)
  WHERE phrase IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 100
), several AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS words FROM counts WHERE k > 1
), inside AS (
  SELECT DISTINCT s.lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, f
  FROM several s, range(2, 5) AS t(size), range(1, 5) AS u(i)
  WHERE size < k AND i + size - 1 <= k
), kept AS (
  SELECT * FROM several s
  WHERE NOT EXISTS (SELECT 1 FROM inside i
                    WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.f >= 100 * s.f)
), cuts AS (
  SELECT lang, phrase, f, cut, array_to_string(words[1:cut], ' ') AS head,
         array_to_string(words[cut + 1:], ' ') AS tail
  FROM kept, range(1, 5) AS t(cut) WHERE cut < k
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, t.total AS n, c.cut,
         CAST((1000::HUGEINT * c.f * t.total) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
  JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
  JOIN totals t ON t.lang = c.lang
), least AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM least
QUALIFY rank <= 2000
"""


@query
def op13_filter_audit(spark, folder):
    return audit.interactions(audit.combinations(table(spark, folder, "documents"),
                                                 table(spark, folder, "labels")))


ORACLE["op13_filter_audit"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), failing AS (
  SELECT doc_id, part,
         [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
          100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM worded
), judged AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS toxic
  FROM (SELECT f.*, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.quality = 1) AS good,
               EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.toxic = 1) AS bad
        FROM failing f)
  GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS letter,
         [instr('ABCDE', filter_order[i]) FOR i IN range(1, step)] AS earlier
  FROM orders, range(1, 6) AS t(step)
), met AS (
  SELECT part, filter_order, step, letter, n, good, toxic,
         fails[instr('ABCDE', letter)] AS here,
         len([i FOR i IN earlier IF fails[i]]) > 0 AS gone,
         len([f FOR f IN fails IF f]) AS failed
  FROM judged, steps
), summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND here), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND here), 0) AS redundant,
         coalesce(sum(n) FILTER (here AND failed = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND here), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND here), 0) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""
