"""Registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.llm import (conversation_repair, decontaminate, exact_dedup, html_text, merkle, mixing, neighbours, passages,
                        simhash, suffix_dedup, token_counts, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@register("op1_mixture", sql=r"""
WITH r AS (SELECT doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][CAST(place % 3 + 1 AS INT)] AS weight,
        [-0.5::DOUBLE, 0.5, 0.0][CAST(place % 3 + 1 AS INT)] AS slope, source_size * 2.0::DOUBLE AS cap FROM p),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
               - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
               / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
g AS (SELECT *, CASE WHEN cap / weight <= level THEN cap
               ELSE max(level) FILTER (WHERE cap / weight > level) OVER () * weight END AS target FROM l),
o AS (SELECT r.*, g.source_size, g.target, g.slope,
        sum(size) OVER (PARTITION BY r.source ORDER BY h, doc_id, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
      FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source),
k AS (SELECT *, CASE WHEN size > 0 THEN greatest(ceil((target - (start + size / 2.0::DOUBLE)) / source_size), 0)
                ELSE 0 END AS passes FROM o)
SELECT doc_id, size, source_size, target, CAST(size * passes AS BIGINT) AS taken,
  CASE WHEN passes = 0 THEN NULL WHEN slope = 0 THEN start / target
       ELSE abs((sqrt((1 - slope) * (1 - slope) + 4 * slope * (start / target)) - (1 - slope)) / (2 * slope)) END
    AS position
FROM k""")
def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words; training positions follow each source's weight schedule."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("positions")


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of every whole text."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), F.col("text"))
    return docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                       count.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > 1024)


@register("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, through its host's wrapper."""
    out = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("__text").alias("text"), F.char_length("__text").cast("long").alias("n_chars"))


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that start at two places of the corpus, removed from every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.remove_repeats(docs, keep_text=False)
    return out.select("doc_id", *[F.col(f"__removed.{c}") for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


@register("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside occurrences of 13-word benchmark windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark")).withColumn("m", F.col("__match"))
    ids = F.array_sort(F.transform(F.col("m.items"), lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("m.n_words").alias("n_words"), decontaminate.hit_words(F.col("m")).alias("n_hit"),
        F.size("m.items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("m")).alias("contaminated"),
        F.coalesce(F.col("m.longest.words"), F.lit(0)).alias("longest_match"))


@register("op6_passages")
def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in fuzzy passages of 50 or more words that stand in other documents too."""
    found = passages.repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


@register("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the longest rule, else by its host's trust and distrust."""
    out = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", *[F.col(f"__url_{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


@register("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products found for every vector whose id is divisible by 20."""
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                       toxicity.score(model, F.col("text"), docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints over 3-word shingles and their components at 3 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


@register("op11_merkle", sql=r"""
WITH RECURSIVE
b AS (SELECT d.*, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) AS crc
      FROM documents d),
f AS (SELECT doc_id, lang, coalesce(xor(crc, 4294967295::BIGINT) % 7 = 0, false) AND n_chars IS NOT NULL AS bad, n_chars,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
          || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail FROM b),
h AS (SELECT doc_id, lang,
        sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') || tail) AS leaf,
        CASE WHEN bad THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR) || tail) END
          AS claim FROM f),
l AS (SELECT doc_id, lang, leaf, coalesce(claim, leaf) AS claim,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM h),
lower_tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM l GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2),
    lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM lower_tree WHERE len(nodes) > 1),
sub AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
        FROM lower_tree WHERE len(nodes) = 1),
upper_tree(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM sub
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2),
    lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM upper_tree WHERE len(nodes) > 1),
steps AS (
  SELECT lang, 0 AS storey, level, nodes FROM lower_tree WHERE len(nodes) > 1
  UNION ALL
  SELECT s.lang, 1, level, nodes FROM upper_tree, sub s WHERE len(nodes) > 1),
walks AS (
  SELECT l.doc_id, l.lang, l.leaf, l.claim, l.pos, s.subroot, s.place,
    (SELECT nodes[1] FROM upper_tree WHERE len(nodes) = 1) AS root FROM l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang),
sides AS (
  SELECT w.lang, w.pos, t.storey * 100 + t.level AS n,
    (CASE t.storey WHEN 0 THEN w.pos ELSE w.place END) >> t.level AS slot,
    coalesce(t.nodes[xor((CASE t.storey WHEN 0 THEN w.pos ELSE w.place END) >> t.level, 1) + 1], '') AS sibling
  FROM walks w JOIN steps t ON w.lang IS NOT DISTINCT FROM t.lang),
paths AS (
  SELECT lang, pos, list({'left': CASE WHEN slot % 2 = 1 THEN sibling ELSE '' END,
                          'right': CASE WHEN slot % 2 = 0 THEN sibling ELSE '' END} ORDER BY n) AS path
  FROM sides GROUP BY lang, pos),
folded AS (
  SELECT w.*, coalesce(p.path, []) AS path FROM walks w
  LEFT JOIN paths p ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos),
climb(lang, pos, i, node) AS (
  SELECT lang, pos, 0, claim FROM folded
  UNION ALL
  SELECT c.lang, c.pos, c.i + 1, sha256(f.path[c.i + 1]['left'] || c.node || f.path[c.i + 1]['right'])
  FROM climb c JOIN folded f ON c.lang IS NOT DISTINCT FROM f.lang AND c.pos = f.pos WHERE c.i < len(f.path))
SELECT f.doc_id, f.leaf, f.subroot, f.root,
  sha256(array_to_string(list_transform(f.path, lambda s: s['left'] || s['right']), '')) AS proof_sha256,
  c.node AS folded_root, c.node = f.root AS verified
FROM folded f JOIN climb c ON c.lang IS NOT DISTINCT FROM f.lang AND c.pos = f.pos AND c.i = len(f.path)""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; one in seven claims a wrong n_chars and fails its proof."""
    def fields(n_chars):
        return F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    docs = docs.withColumn("claim", F.when(tampered, merkle.leaf(*fields(F.try_add("n_chars", F.lit(1))))))
    found = merkle.manifest(docs, merkle.leaf(*fields(F.col("n_chars"))), F.col("lang"), F.col("doc_id"), ["doc_id", "claim"])
    found = found.select("doc_id", "claim", "__proof.*")
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.coalesce("claim", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@register("op13_exact_dedup", sql="""
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT *, count(*) OVER w AS group_size, max(doc_id) OVER w AS keep_id,
        row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept
      FROM t WINDOW w AS (PARTITION BY body))
SELECT doc_id, keep_id, group_size, kept, sha256(body) AS text_sha256 FROM g""")
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents: each row's group, and the row of it that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = exact_dedup.exact_groups(docs, F.col("text"), "doc_id", ["doc_id", "text_sha256"])
    return found.select("doc_id", "__exact.*", "text_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the damage that op12 asks for: dropped, emptied, cut, repeated and reroled rows."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part[3], "[.!?]", "")).otherwise(part[3])
    role = F.when(kind == 4, "user").otherwise(part[2])
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))


@register("op12_conversation_repair", sql=r"""
WITH RECURSIVE
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
coded AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''),
          lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 20 AS kind
      FROM raw),
dirty AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM coded, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dirty),
ended AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy FROM placed),
r AS (SELECT *, CASE WHEN shown = '' THEN 'b' WHEN copy > 1 THEN 'd'
               WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        CASE WHEN role[1:1] IN ('s', 'u', 'a') THEN role[1:1] ELSE 'o' END AS cls,
        lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ended),
stats AS (SELECT conv_id, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
            count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
            count(*) FILTER (fault = 't') AS truncated,
            count(*) FILTER (before || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
          FROM r GROUP BY conv_id),
move(role, a, b) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
ins(a, b, cost, audit) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'),
  (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
sym AS (SELECT DISTINCT cls, fault FROM r),
edit AS (
  SELECT cls, fault, s AS a, s AS b, 4 AS cost, 'D' AS audit FROM sym, range(4) t(s)
  UNION ALL
  SELECT cls, fault, a, b, CASE WHEN role = cls THEN 0 ELSE 3 END + CASE fault WHEN 't' THEN 3 ELSE 0 END,
    CASE WHEN role = cls THEN 'K' ELSE 'R' END
  FROM sym, move WHERE fault IN ('', 't') AND (role = cls OR role IN ('u', 'a'))),
step AS (SELECT e.cls, e.fault, e.a, i.b, min({'cost': e.cost + i.cost, 'audit': e.audit || i.audit}) AS way
         FROM edit e JOIN ins i ON e.b = i.a GROUP BY ALL),
walk(conv_id, i, b, way) AS (
  SELECT s.conv_id, 0::BIGINT, ins.b, {'cost': ins.cost, 'audit': ins.audit} FROM stats s, ins WHERE ins.a = 0
  UNION ALL
  SELECT w.conv_id, w.i + 1, t.b, min({'cost': w.way.cost + t.way.cost, 'audit': w.way.audit || t.way.audit})
  FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN step t ON t.cls = r.cls AND t.fault = r.fault AND t.a = w.b
  GROUP BY w.conv_id, w.i, t.b),
best AS (SELECT s.conv_id, min(w.way) AS way FROM walk w JOIN stats s
           ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i WHERE w.b IN (0, 3) GROUP BY s.conv_id),
letters AS (SELECT conv_id, unnest(string_split(way.audit, '')) AS letter, generate_subscripts(string_split(way.audit, ''), 1) AS k
            FROM best WHERE way.audit <> ''),
consumed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o
             FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
kept AS (SELECT c.conv_id, c.k, c.letter, c.o, CASE WHEN letter <> 'I' THEN r.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE r.text END AS text,
           max(CASE WHEN c.o = 1 AND letter = 'K' AND r.cls = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS shift
         FROM consumed c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.i WHERE letter <> 'D'),
joined AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
             || ':' || text, chr(10) ORDER BY k)) AS repaired_sha256 FROM kept GROUP BY conv_id)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
  coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, CAST(coalesce(b.way.cost, 0) AS BIGINT) AS cost,
  coalesce(b.way.audit, '') AS audit, coalesce(j.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM c.conv_id""")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.Repair(damaged(rows), *[F.col(c) for c in ("conv_id", "turn", "role", "text")]).conversations()
    found = found.withColumnRenamed("conv", "found_id")
    out = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
