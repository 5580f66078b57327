"""The registered queries of the subpackage: each applies one operator to the
whole of its table and derives the columns of its contract from the result."""

from __future__ import annotations

import string
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, forced, packing, pii, quality, secrets, sharding, simhash, spelling, syncmers, training_order, tries, urls, vocab
from quire.session import checkpoint_dir, materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``: 3-word shingles, 3 bits."""
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        simhash.hex16(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = secrets.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` in 8 shards of near-equal bytes, in the order of doc_id."""
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("tie"),
    )
    narrow = materialize(narrow, "sizes")
    sharded = sharding.histogram_shards(narrow, F.col("doc_id"), F.col("tie"), F.col("size"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# Words, windows and lines as rows; references are shares among all words and
# all characters of a language.
ORACLE_QUALITY = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
), l AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM d
), w AS (
  SELECT doc_id, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM l
), v AS (
  SELECT *, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS win FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM v WHERE win IS NOT NULL) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id
), f AS (
  SELECT doc_id, lang, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    length(t) AS n_chars,
    [length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')), length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')),
     length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')), length(regexp_replace(t, '[^#*$%&|<>=+/\\_@^~`{}\[\]]', '', 'g')), length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))] AS c6
  FROM l
), g AS (SELECT *, list_append(c6, n_chars - list_sum(c6)::BIGINT) AS classes FROM f),
langs AS (SELECT lang, sum(n_words) AS words, sum(n_chars) AS chars FROM g WHERE lang IS NOT NULL GROUP BY lang),
cls AS (SELECT lang, k, sum(classes[k + 1]) / any_value(chars) AS q FROM g JOIN langs USING (lang), range(7) r(k) GROUP BY lang, k),
top AS (
  SELECT lang, word, n / words AS q FROM (SELECT lang, word, count(*) AS n FROM w GROUP BY lang, word) JOIN langs USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 64
), cd AS (
  SELECT doc_id, min(x) AS class_distance FROM (
    SELECT doc_id, c.lang, sqrt(greatest(0, sum((CASE WHEN classes[k + 1] > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS x
    FROM (SELECT *, classes[k + 1] / n_chars AS p FROM g, range(7) r(k) WHERE n_chars >= 200 AND n_words >= 50) a JOIN cls c USING (k) GROUP BY doc_id, c.lang) GROUP BY doc_id
), wc AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY doc_id, word),
wp AS (
  SELECT doc_id, t.lang, n / n_words AS p, q FROM wc JOIN top t USING (word) JOIN g USING (doc_id) WHERE n_words >= 50
), ws2 AS (
  SELECT doc_id, lang, sum((p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) / 2) AS x, sum(p) AS p, sum(q) AS q FROM wp GROUP BY doc_id, lang
), wd AS (
  SELECT doc_id, min(sqrt(greatest(0, x + (listed - q) / 2 + (CASE WHEN 1 - p > 0 THEN (1 - p) * log2(2 * (1 - p) / (1 - p + 1 - listed)) ELSE 0 END + CASE WHEN 1 - listed > 0 THEN (1 - listed) * log2(2 * (1 - listed) / (1 - p + 1 - listed)) ELSE 0 END) / 2))) AS word_distance
  FROM (SELECT doc_id, t.lang, coalesce(x, 0) AS x, coalesce(p, 0) AS p, coalesce(s.q, 0) AS q, listed FROM (SELECT doc_id FROM g WHERE n_words >= 50) CROSS JOIN (SELECT lang, sum(q) AS listed FROM top GROUP BY lang) t LEFT JOIN ws2 s USING (doc_id, lang))
  GROUP BY doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  (n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words) AND coalesce(class_distance, 0) <= 0.28 AND coalesce(word_distance, 0) <= 0.45 AS kept
FROM g LEFT JOIN rep USING (doc_id) LEFT JOIN cd USING (doc_id) LEFT JOIN wd USING (doc_id)
"""


# Shard boundaries are where the bytes before a row come nearest to a share.
# CRC-32 (polynomial edb88320, reflected) from a table, byte by byte.
ORACLE_SHARDING = """
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM d
), cuts AS (
  SELECT j, (SELECT b FROM (SELECT before AS b, total FROM s UNION ALL SELECT total, total FROM s) ORDER BY abs(8 * b - j * total), b LIMIT 1) AS cut
  FROM range(1, 8) r(j)
), p AS (
  SELECT *, (SELECT count(*) FROM cuts WHERE before >= cut)::INTEGER AS shard FROM s
)
SELECT doc_id, size,
  xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]))) AS text_crc32,
  'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM p, crc
"""


END_OF_DOCUMENT = 1


def _tokenizer(spark: SparkSession):
    return vocab.word_bpe_tokens(spark, public_tokenizers.path("word_bpe_49k.json"), END_OF_DOCUMENT)


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` in sequences of at most 2048 word-BPE ids, each
    document followed by id 1; one row a piece."""
    pieces = packing.pack_documents(docs.select("doc_id", "text"), "text", _tokenizer(spark))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 ids."""
    return packed(spark, table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    found = pii.find(table(spark, sf_dir, "documents"), F.col("text"), {"doc_id": F.col("doc_id")})
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in pii.BASE_KINDS),
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features and verdict of every text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge(docs, F.col("text"), F.col("lang"), {"doc_id": F.col("doc_id")})
    return judged.drop("class_distance", "word_distance")


#: Rules of the registered query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page; URLs decided by a rule train the trees."""
    return urls.filter_urls(table(spark, sf_dir, "pages"), "url", URL_RULES, {"page_id": F.col("page_id")})


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text of ``documents``, and the bytes they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, "text", ranks, public_tokenizers.PATTERN, decoded=True)
    return ids.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text of ``documents`` and of its edited text."""
    pairs = syncmers.against_next(table(spark, sf_dir, "documents"))
    return pairs.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        syncmers.printed(F.col("own")).alias("fingerprint"),
        syncmers.printed(F.col("edited_own")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        syncmers.likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


TRAINING_KEY = 20260


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents`` in training order: written as
    fixed-stride shards, read back, and met with their manifest."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/training-order-{uuid.uuid4().hex}"
    seqs = packing.packed_sequences(table(spark, sf_dir, "documents"), "text", _tokenizer(spark), training_order.compressed_record)
    training_order.write_records(seqs, path, TRAINING_KEY)
    records = training_order.read_records(spark, path).select("slot", F.crc32("bytes").alias("record_crc32"), F.length("bytes").cast("bigint").alias("record_bytes"))
    return spark.read.parquet(f"{path}/manifest").join(records, "slot").select("slot", "shard", "record", "number", "sequence_id", "n_ids", "record_bytes", "record_crc32")


def op11_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text of ``documents`` by the word BPE, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = forced.encode(docs, "text", public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return ids.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _misspelt_words(docs: DataFrame) -> DataFrame:
    """``word, n``: the letter runs of all texts, of which about one in 31 loses a
    code point, that are left with at least 7 code points and occur at least
    twice.  Null texts have none; a null id counts as the empty string."""
    runs = F.regexp_extract_all(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), F.lit("[a-z\\u00C0-\\u00FF]+"), F.lit(0))
    # a run never grows, so short ones go first
    held = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.filter(runs, lambda r: F.length(r) >= 7)).alias("run"))
    hashed = held.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= 7)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all ``documents``."""
    return spelling.variants(_misspelt_words(table(spark, sf_dir, "documents")), ratio=10)


# Near words share what is left when a code point is deleted: at the same place
# of both (replaced), or one of them is what is left of the other.
ORACLE_SPELLING = """
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents
), counted AS (
  SELECT w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs WHERE length(w) >= 7 GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]))) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS c FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.c = b.c AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word FROM cut a JOIN words w ON a.c = w.word
  UNION SELECT w.word, a.word FROM cut a JOIN words w ON a.c = w.word
), ranked AS (
  SELECT p.word, near, n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY n DESC, near) AS k
  FROM pairs p JOIN words w ON p.near = w.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= 10 * w.n THEN near END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1
), walk AS (
  SELECT word, word AS at, form AS onward FROM formed
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON w.onward = f.word
)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk w ON w.word = f.word AND w.onward IS NULL
"""


def _rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: conversation c takes the first h turns
    of c - c % 5, then its own after its first h; h = crc32(c) % 9.  Returns the
    turns with their new places, and all conversations."""
    h = lambda c: F.crc32(c.cast("string").cast("binary")) % 9
    convs = materialize(turns.groupBy("conv").agg(F.max("place").alias("n")), "conversations")
    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    begun = convs.withColumn("base", F.col("conv") - F.col("conv") % 5).join(base, "base", "left")
    taken = begun.select("conv", F.least(h(F.col("conv")), F.coalesce("base_n", F.lit(0))).alias("taken"))
    own = turns.where(F.col("place") > h(F.col("conv"))).join(taken, "conv")
    own = own.select("conv", (F.col("place") - h(F.col("conv")) + F.col("taken")).alias("place"), "t1", "t2", "size")
    # the beginnings: at most 8 turns of a conversation, for those that may take them
    heads = turns.where("conv % 5 = 0 AND place <= 8").withColumnRenamed("conv", "base")
    heads = heads.withColumn("conv", F.explode(F.sequence(F.col("base") - 4, F.col("base") + 4))).where("conv - conv % 5 = base")
    heads = heads.where(F.col("place") <= h(F.col("conv"))).join(convs.select("conv"), "conv", "left_semi")
    return own.unionByName(heads.select(own.columns)), convs.select("conv")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations``."""
    turns = materialize(tries.turn_rows(table(spark, sf_dir, "conversations")), "turns")
    nodes = tries.prefix_trie(*_rebuilt_turns(turns))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"
    )


# A node's ancestors are the shorter prefixes of its smallest member.
ORACLE_TRIE = """
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), lens AS (SELECT conv_id, count(*) AS n, hex(encode(conv_id::VARCHAR)) AS x FROM turns GROUP BY conv_id),
convs AS (
  SELECT a.conv_id, a.conv_id - a.conv_id % 5 AS base, coalesce(b.n, 0) AS base_n,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(a.x) // 2), lambda i: ('0x' || substr(a.x, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]))) % 9 AS h
  FROM lens a LEFT JOIN lens b ON b.conv_id = a.conv_id - a.conv_id % 5, crc
), rebuilt AS (
  SELECT c.conv_id, t.pos AS d, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, least(h, base_n) + t.pos - h, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), prefixes AS (
  SELECT conv_id, d, md5(string_agg(md5(role) || md5(text), ',' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS k, strlen(text) AS size FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM convs
), ends AS (
  SELECT d, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS listed
  FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM prefixes) WHERE d = last GROUP BY d, k
), nodes AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM prefixes GROUP BY d, k),
up AS (
  SELECT n.d, n.conv_id, p.conv_id AS parent_conv_id FROM nodes n JOIN prefixes f ON f.conv_id = n.conv_id AND f.d = n.d - 1 JOIN nodes p ON p.d = f.d AND p.k = f.k
), children AS (SELECT d - 1 AS d, parent_conv_id AS conv_id, count(*) AS n_children FROM up GROUP BY 1, 2),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (d, conv_id)),
totals AS (
  SELECT f.d, f.k, sum((n.n_children = 0)::INT) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved
  FROM full_nodes n JOIN prefixes f ON f.conv_id = n.conv_id AND f.d <= n.d GROUP BY f.d, f.k
)
SELECT n.conv_id, n.d::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(listed, '')) AS ends_sha256
FROM full_nodes n JOIN totals USING (d, k) LEFT JOIN up USING (d, conv_id) LEFT JOIN ends USING (d, k)
"""


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_secrets": op2_secrets,
    "op3_sharding": op3_sharding,
    "op4_packing": op4_packing,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_urls": op7_urls,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_syncmers": op9_syncmers,
    "op10_training_order": op10_training_order,
    "op11_forced_bpe": op11_forced_bpe,
    "op12_spelling": op12_spelling,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE_SQL = {
    "op3_sharding": ORACLE_SHARDING,
    "op6_quality": ORACLE_QUALITY,
    "op12_spelling": ORACLE_SPELLING,
    "op13_conversation_trie": ORACLE_TRIE,
}
