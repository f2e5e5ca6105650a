"""The operators over the test tables, one query each, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (
    bpe, decontaminate, fingerprints, language, linededup, neardup, phrases, preference, pseudonyms, repair, secretscan, toxicity, urlfilter,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PSEUDONYM_KEY = "corpus pseudonyms, first key"
#: Verdict, host and path of the rules that the query asks for.
URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, of: int) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(of))


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as the chosen one; rejected is the same with its last assistant turn taken from the next
    conversation (by id, else the one before, else its own)."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    after = last.select((F.col("pair_id") - 1).alias("pair_id"), F.col("last.text").alias("after"))
    before = last.select((F.col("pair_id") + 1).alias("pair_id"), F.col("last.text").alias("before"))
    swap = last.join(after, "pair_id", "left").join(before, "pair_id", "left").select(
        "pair_id", F.col("last.turn").alias("at"), F.coalesce("after", "before", "last.text").alias("swapped")
    )
    here = (F.col("turn") == F.col("at")) & (F.col("role") == "assistant")
    rejected = turns.join(swap, "pair_id", "left").select(
        "pair_id", "turn", "role", F.when(here, F.col("swapped")).otherwise(F.col("text")).alias("text")
    )
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.array_join(s.cast("array<string>"), "-")), ",")
    pairs = preference.preference_pairs(turns, rejected)
    return pairs.withColumns({c: spans(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and decoded from its ids."""
    tokenizer = bpe.broadcast_tokenizer(spark, TOKENIZER)
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer).drop("text")
    ids = F.col("token_ids")
    return bpe.decode(encoded, tokenizer).select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_parsing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt from two thirds of the rows."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.train(docs.filter(~held_out))
    predicted = language.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_min_max_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates by two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand earlier in the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


def op8_bm25_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items found in them."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learnt from the labels of four fifths of the rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e.key).alias("evidence"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults dealt by a checksum of conversation and turn; nulls become one blank."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hurt = turns.withColumn("hit", F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).filter("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(spaced("role"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, which follow each other; no more than a batch is held."""
    digest, conv, started = hashlib.sha256(), None, False
    for batch in batches:
        done = []
        for now, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist()):
            if started and now == conv:
                digest.update(b"\n")
            else:
                done += [(conv, digest.hexdigest())] if started else []
                digest, conv, started = hashlib.sha256(), now, True
            digest.update(line.encode())
        yield pa.RecordBatch.from_pylist([{"_conv": c, "sha": d} for c, d in done], pa.schema([("_conv", pa.int64()), ("sha", pa.string())]))
    if started:
        yield pa.RecordBatch.from_pylist([{"_conv": conv, "sha": digest.hexdigest()}], pa.schema([("_conv", pa.int64()), ("sha", pa.string())]))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged, with its faults, the cheapest edits and a digest of what they leave."""
    turns = table(spark, sf_dir, "conversations")
    mended = repair.repair(damaged(turns))
    lines = mended.turns.select("conv_id", "chunk", "pos", F.concat_ws(":", "role", "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "pos").select("conv_id", "line")
    digests = lines.mapInArrow(_digests, "_conv bigint, sha string")
    found = mended.conversations.withColumnRenamed("conv_id", "_found")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256")
    )


def op13_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document is a repository, its source the owner."""
    found = secretscan.scan(table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of_kind = lambda *kinds: F.filter("spans", lambda s: s.kind.isin(*kinds))
    judged = lambda verdict: F.size(F.filter("spans", lambda s: s.verdict == verdict)).cast("long")
    return found.select(
        "doc_id", *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in secretscan.KINDS[: secretscan.TOKEN]),
        F.sha2(listed(of_kind(*secretscan.KINDS[: secretscan.TOKEN])), 256).alias("base_sha256"), listed("spans").alias("spans"),
        judged("live").alias("n_live"), judged("copied").alias("n_copied"),
    )


_TURN = r"""'<|im_start|>' || {0} || chr(10) || regexp_replace(coalesce({1}, ''), '<\|(im_start|im_end)\|>', '<| \1 |>', 'g') || '<|im_end|>' || chr(10)"""


def _sql_side(side: str) -> str:
    """SQL for a completion and its mask; heads are parted from texts to count characters."""
    turn = _TURN.format("coalesce(x.role, '')", "x.text")
    head = "length('<|im_start|>' || coalesce(x.role, '') || chr(10))"
    rest = f"{side}[n + 1:]"
    until = f"CAST(coalesce(list_sum(list_transform({rest}[1:i - 1], lambda x: length({turn}))), 0) AS BIGINT)"
    span = f"list_transform([{rest}[i]], lambda x: ({until} + {head}) || '-' || ({until} + length({turn}) - 1))[1]"
    spans = f"list_transform(list_filter(range(1, len({rest}) + 1), lambda i: {rest}[i].role = 'assistant'), lambda i: {span})"
    return f"array_to_string(list_transform({rest}, lambda x: {turn}), '') AS {side}, array_to_string({spans}, ',') AS {side}_mask"


_FAR = 1 << 50


def _sql_state(of: str, cost: str, edit: str, line: str) -> str:
    """A way that goes on: its cost, audit and the lines it leaves, each after a line feed."""
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{edit}', 't': {of}.t || {line}}}"


def _sql_least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_SQL_USER, _SQL_ASSISTANT = ("chr(10) || 'user:'", "chr(10) || 'assistant:'")
def _sql_inserted(rows: str) -> str:
    """Ways after the cheapest insertions: ``u_`` and ``a_``; the other two cannot be reached by them."""
    users = _sql_least("u", *(_sql_state(x, "5", "I", _SQL_USER) for x in "esa"))
    return f"u1 AS (SELECT *, {users} AS u_ FROM {rows}), a1 AS (SELECT *, {_sql_least('a', _sql_state('u_', '5', 'I', _SQL_ASSISTANT))} AS a_ FROM u1)"


_SQL_KEEP = "CASE WHEN gone OR ini <> '{0}' THEN " + str(_FAR) + " ELSE extra END"
_SQL_RETAG = "CASE WHEN gone THEN " + str(_FAR) + " ELSE 1 + extra END"
_SQL_ROW, _SQL_DELETED = "chr(10) || role || ':' || text", "''"

ORACLES = {
    "op11_phrase_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
f1 AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY lang, x),
f2 AS (SELECT lang, z[1] AS x, z[2] AS y, count(*) AS f FROM (SELECT lang, unnest(list_zip(w[:-2], w[2:])) AS z FROM w WHERE len(w) > 1) GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, z[1] AS x, z[2] AS y, z[3] AS z_, count(*) AS f FROM (SELECT lang, unnest(list_zip(w[:-3], w[2:-2], w[3:])) AS z FROM w WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10),
c3 AS (SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z_ AS phrase, f3.f AS a, a.f AS l1, bc.f AS r1, ab.f AS l2, c.f AS r2 FROM f3
  JOIN f1 a ON a.lang = f3.lang AND a.x = f3.x JOIN f1 c ON c.lang = f3.lang AND c.x = f3.z_
  JOIN f2 ab ON ab.lang = f3.lang AND ab.x = f3.x AND ab.y = f3.y JOIN f2 bc ON bc.lang = f3.lang AND bc.x = f3.y AND bc.y = f3.z_),
s3 AS (SELECT *, (1000000::HUGEINT * a * a) // (l1::HUGEINT * r1) AS s1, (1000000::HUGEINT * a * a) // (l2::HUGEINT * r2) AS s2 FROM c3),
o AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z_, f FROM f3) GROUP BY ALL),
c AS (SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r, CAST(least(s1, s2) AS BIGINT) AS score FROM s3
  UNION ALL SELECT f2.lang, f2.x || ' ' || f2.y, f2.f, a.f, b.f, CAST((1000000::HUGEINT * f2.f * f2.f) // (a.f::HUGEINT * b.f) AS BIGINT) FROM f2
  JOIN f1 a ON a.lang = f2.lang AND a.x = f2.x JOIN f1 b ON b.lang = f2.lang AND b.x = f2.y
  LEFT JOIN o ON o.lang = f2.lang AND o.x = f2.x AND o.y = f2.y WHERE o.f IS NULL OR 100 * o.f < 50 * f2.f),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT * FROM (SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM c JOIN n ON n.lang = c.lang) WHERE rank <= 2000""",
    "op12_turn_repair": rf"""
WITH RECURSIVE k AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS k),
b AS (SELECT *, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS b FROM conversations),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, k[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS hit FROM b, k),
d AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE hit <> 0),
e AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, left(role, 1) AS ini,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
r AS (SELECT conv_id, turn, role, text, ini, i, solid = '' AS blank, solid <> '' AND again AS duplicate, solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS cut,
  i > 1 AND lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS bad FROM e),
g AS (SELECT *, blank OR duplicate AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS extra, count(*) OVER (PARTITION BY conv_id) AS rows FROM r),
st AS (SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS e, {{'c': {_FAR}::BIGINT, 'a': '', 't': ''}} AS s, {{'c': {_FAR}::BIGINT, 'a': '', 't': ''}} AS u, {{'c': {_FAR}::BIGINT, 'a': '', 't': ''}} AS a FROM g WHERE i = 1
 UNION ALL (WITH before AS (SELECT st.conv_id, st.i, e, s, u, a, role, text, ini, gone, extra FROM st JOIN g ON g.conv_id IS NOT DISTINCT FROM st.conv_id AND g.i = st.i + 1),
  {_sql_inserted('before')}
  SELECT conv_id, i + 1, {_sql_state('e', '2', 'D', _SQL_DELETED)},
   {_sql_least(_sql_state('s', '2', 'D', _SQL_DELETED), _sql_state('e', _SQL_KEEP.format('s'), 'K', _SQL_ROW))},
   {_sql_least(_sql_state('u_', '2', 'D', _SQL_DELETED), *(_sql_state(x, _SQL_KEEP.format('u'), 'K', _SQL_ROW) for x in ('e', 's', 'a_')), *(_sql_state(x, _SQL_RETAG, 'R', _SQL_USER + ' || text') for x in ('e', 's', 'a_')))},
   {_sql_least(_sql_state('a_', '2', 'D', _SQL_DELETED), _sql_state('u_', _SQL_KEEP.format('a'), 'K', _SQL_ROW), _sql_state('u_', _SQL_RETAG, 'R', _SQL_ASSISTANT + ' || text'))} FROM a1)),
z AS (SELECT st.* FROM st JOIN (SELECT conv_id, max(rows) AS rows FROM g GROUP BY conv_id) n ON n.conv_id IS NOT DISTINCT FROM st.conv_id AND n.rows = st.i),
y AS (WITH {_sql_inserted('z')} SELECT conv_id, {_sql_least('e', 'a_')} AS best FROM a1),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
  count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE bad) AS illegal FROM g GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op2_preference_pairs": f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM t WHERE role = 'assistant' GROUP BY conv_id),
s AS (SELECT l.conv_id, l.turn, coalesce(a.text, b.text, l.text) AS text FROM l
      LEFT JOIN l a ON a.conv_id = l.conv_id + 1 LEFT JOIN l b ON b.conv_id = l.conv_id - 1),
p AS (SELECT t.conv_id AS pair_id, list({{'role': t.role, 'text': t.text}} ORDER BY t.turn, t.role, t.text) AS chosen,
        list({{'role': t.role, 'text': CASE WHEN s.turn = t.turn AND t.role = 'assistant' THEN s.text ELSE t.text END}} ORDER BY t.turn, t.role, t.text) AS rejected
      FROM t LEFT JOIN s ON s.conv_id = t.conv_id GROUP BY t.conv_id),
q AS (SELECT *, coalesce(list_position(list_transform(range(1, len(chosen) + 1), lambda i: chosen[i] IS NOT DISTINCT FROM rejected[i]), false) - 1, len(chosen)) AS n FROM p)
SELECT pair_id, CAST(n AS INTEGER) AS prompt_turns, n < len(chosen) AS differs,
  array_to_string(list_transform(chosen[1:n], lambda x: {_TURN.format("coalesce(x.role, '')", "x.text")}), '') AS prompt,
  {_sql_side("chosen")}, {_sql_side("rejected")}
FROM q""",
    "op6_min_max_neardup": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
g AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT g.b, r.root FROM r JOIN g ON g.a = r.id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id, min(r.root) = s.doc_id AS kept
FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, s.s""",
    "op7_line_dedup": """
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
d AS (SELECT line, length(line) AS n, min({'doc': doc_id, 'pos': pos}) AS place FROM l WHERE trim(line, ' ') <> '' GROUP BY line),
v AS (SELECT n, place, i, md5(substr(line, 1, i - 1) || substr(line, i + 1)) AS x FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM d WHERE n >= 20)),
m AS (SELECT n, i, x, min(place) AS first FROM v GROUP BY n, i, x),
z AS (SELECT DISTINCT s.n, s.place AS short, v.place AS long FROM (SELECT n, place, md5(line) AS x FROM d WHERE n >= 20) s JOIN v ON v.x = s.x AND v.n = s.n + 1),
near AS (SELECT DISTINCT v.place FROM v JOIN m ON m.n = v.n AND m.i = v.i AND m.x = v.x AND m.first < v.place
         UNION SELECT greatest(short, long) FROM z),
k AS (SELECT l.doc_id, l.pos, l.line, d.place IS NOT NULL AND ({'doc': l.doc_id, 'pos': l.pos} <> d.place OR d.place IN (SELECT place FROM near)) AS gone FROM l LEFT JOIN d ON d.line = l.line)
SELECT o.doc_id, count(k.pos) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  CASE WHEN o.text IS NOT NULL THEN coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE NOT gone), '') END AS text
FROM documents o LEFT JOIN k ON k.doc_id = o.doc_id GROUP BY o.doc_id, o.text""",
    "op9_url_trie": r"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS behind FROM pages),
h AS (SELECT *, split_part(split_part(split_part(behind, '/', 1), '?', 1), '#', 1) AS raw FROM a),
u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  split_part(split_part(substr(behind, length(raw) + 1), '?', 1), '#', 1) AS path FROM h),
r AS (SELECT *, CASE
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_feistel_pseudonyms, op2_preference_pairs, op3_bpe_transducer, op4_parsing_fingerprints, op5_language_id,
        op6_min_max_neardup, op7_line_dedup, op8_bm25_decontaminate, op9_url_trie, op10_toxicity_neighbours, op11_phrase_collocations, op12_turn_repair, op13_secret_owners,
    )
}
