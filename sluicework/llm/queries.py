"""The corpus queries: each applies one operator, with production parameters, to its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import hit_words, mark

    found = mark(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    hit = hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign

    docs = common.table(spark, sf_dir, "documents")
    rows = assign(docs, ["source", "lang", "n_chars"], shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(common.table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, held_out, score

    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    rows = score(docs, model, "doc_id")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(common.table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op6_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import MELS, TENSOR_FRAMES, read_audio, read_features, store_audio, store_features

    path, stored = common.new_path(spark, "audio"), common.new_path(spark, "features")
    store_audio(common.table(spark, sf_dir, "documents"), path, "doc_id")
    store_features(read_audio(spark, path), stored, "doc_id", "n_bytes")
    found = read_features(spark, stored)
    active = F.aggregate("segments", F.lit(0.0), lambda a, s: a + s["end"] - s["start"])
    shown = F.array_join(F.transform("mean_level", lambda v: v.cast("decimal(9,1)").cast("string")), ",")
    feature = F.concat_ws(";", F.format_string("%dx%dx%d", F.size("spans"), F.lit(TENSOR_FRAMES), F.lit(MELS)), F.size("segments").cast("string"), active.cast("decimal(18,3)").cast("string"), shown)
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "segments", "spans", "log_mel_sha256")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .main_text import main_text

    found = main_text(common.table(spark, sf_dir, "pages"), "page_id", "url")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import joined, personal_data

    found = personal_data(common.table(spark, sf_dir, "documents"), "doc_id")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, _tokenizer("word_bpe_49k.json"), common.new_path(spark, "token-counts"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_file import read_documents, write_tokens

    path = common.new_path(spark, "token-file")
    write_tokens(common.table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), path, end_id=2)
    return read_documents(spark, path)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import encode

    return encode(common.table(spark, sf_dir, "embeddings"), "embedding", "vec_id", "label")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversations import damaged, repair

    turns = common.table(spark, sf_dir, "conversations")
    return repair(damaged(turns), turns.select("conv_id"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, held_out, predict

    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))), _tokenizer("piece_bpe_32k.model"))
    return predict(docs, model, "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_hilbert_sharding, op3_jaccard_join, op4_toxicity, op5_packing, op6_audio_features, op7_main_text, op8_personal_data, op9_token_counts, op10_token_file, op11_vector_codes, op12_conversation_repair, op13_language)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CHUNKS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"



def _lloyd_sql() -> str:
    """All rounds written out: each assigns every part by full comparison and replaces used entries by floors of means."""

    def assigned(i: int) -> str:
        return f"""a{i} AS (SELECT id, p.m AS m, x, arg_min(j, (list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e), j)) AS j,
 min(list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e)) AS d FROM p JOIN b{i} ON p.m = b{i}.m GROUP BY id, p.m, x)"""

    steps = []
    for i in range(4):
        steps += [assigned(i), f"""b{i + 1} AS (SELECT b{i}.m AS m, b{i}.j AS j, coalesce(n.e, b{i}.e) AS e FROM b{i} LEFT JOIN (SELECT m, j, list(v ORDER BY pos) AS e FROM
 (SELECT m, j, pos, floor(sum(x[pos]) / count(*)) AS v FROM (SELECT m, j, x, unnest(range(1, len(x) + 1)) AS pos FROM a{i}) GROUP BY m, j, pos) GROUP BY m, j) n ON n.m = b{i}.m AND n.j = b{i}.j)"""]
    return f"""
WITH k AS (SELECT vec_id AS id, label, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS q FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT id, m, list_slice(q, m * (len(q) // 4) + 1, (m + 1) * (len(q) // 4)) AS x FROM k, (SELECT unnest(range(4)) AS m)),
b0 AS (SELECT m, row_number() OVER (PARTITION BY m ORDER BY id) - 1 AS j, x AS e FROM p QUALIFY j < 256),
{", ".join([*steps, assigned(4)])},
o AS (SELECT id, string_agg(printf('%02x', j), '' ORDER BY m) AS code, CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY id),
h AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY m, j, pos)) AS codebooks_sha256 FROM (SELECT m, j, unnest(range(1, len(e) + 1)) AS pos, unnest(e) AS v FROM b4))
SELECT id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN k USING (id), h"""


def _repair_sql() -> str:
    """The grammar's four states, turn by turn; each holds the least (cost, audit) and its repaired lines. crc32 is written out over the key's digits."""

    def to(state: str, cost: str, edit: str, line: str | None = None) -> str:
        lines = f"list_append({state}.r, {line})" if line else f"{state}.r"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 't': {state}.t || '{edit}', 'r': {lines}}} END"

    def taken(state: str, initial: str, role: str | None) -> list[str]:
        ways = [f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {to(state, '5 * cut', 'K', chr(39) + chr(39) + ' || role || ' + chr(39) + ':' + chr(39) + ' || text')} END"]
        return ways + ([f"CASE WHEN NOT gone THEN {to(state, '1 + 5 * cut', 'R', f"'{role}:' || text")} END"] if role else [])

    user, helper = "'user:'", "'assistant:'"
    made = f"""SELECT *, least(u, {to('e', '5', 'I', user)}, {to('s', '5', 'I', user)}, {to('a', '5', 'I', user)}) AS u1 FROM st"""
    made = f"SELECT *, least(a, {to('u1', '5', 'I', helper)}) AS a1 FROM ({made})"
    nothing = "{'c': 0::BIGINT, 't': '', 'r': []::VARCHAR[]}"
    none = f"CASE WHEN false THEN {nothing} END"
    return f"""
WITH RECURSIVE t AS (SELECT [list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n) for n in range(256)] AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 xor(list_reduce([ord(c) for c in string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')], lambda v, c: xor(v >> 8, t[(xor(v, c) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM conversations, t),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, E' \t\n\x0b\x0c\r') AS bare FROM d),
f AS (SELECT conv_id, turn, role, text, i, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before, bare FROM o),
g AS (SELECT *, blank OR again AS gone, CASE WHEN NOT (blank OR again) AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM f),
st(conv_id, i, e, s, u, a) AS (SELECT DISTINCT conv_id, 0::BIGINT, {nothing}, {none}, {none}, {none} FROM g
 UNION ALL SELECT m.conv_id, g.i, {to('e', '2', 'D')}, least({to('s', '2', 'D')}, {taken('e', 's', None)[0]}),
  least({to('u1', '2', 'D')}, {", ".join(x for state in ("e", "s", "a1") for x in taken(state, "u", "user"))}), least({to('a1', '2', 'D')}, {", ".join(taken("u1", "a", "assistant"))})
  FROM ({made}) m JOIN g ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND g.i = m.i + 1),
z AS (SELECT conv_id, least(e, a1) AS z FROM ({made}) m QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(again) AS duplicate, sum(cut) AS truncated,
 count_if(before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, coalesce(illegal, 0) AS illegal,
 coalesce(z.c, 0) AS cost, coalesce(z.t, '') AS audit, sha256(coalesce(array_to_string(z.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


#: DuckDB's form of a query, where it can express it.
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
 k AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
 g AS (SELECT DISTINCT item, k, list_slice(w, p, p + k - 1) AS gram FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM k)),
 v AS (SELECT doc_id, k, p, list_slice(w, p, p + k - 1) AS gram FROM (SELECT doc_id, w, n.k AS k, unnest(range(1, len(w) - n.k + 2)) AS p FROM d, (SELECT DISTINCT k FROM g) n WHERE len(w) >= n.k)),
 h AS (SELECT DISTINCT doc_id, v.p AS p, v.k AS k, item FROM v JOIN g ON v.k = g.k AND v.gram = g.gram),
 c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY doc_id),
 i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN i ON d.doc_id = i.doc_id""",
    "op3_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_CHUNKS} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE list_slice(w, p, p + 2) END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS p FROM d WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
 l AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)),
 e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
 r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
 c AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.x""",
    "op11_vector_codes": _lloyd_sql(),
    "op12_conversation_repair": _repair_sql(),
}
