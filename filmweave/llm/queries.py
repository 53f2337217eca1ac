"""Registered queries of the training-data operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontam, embeddings, exact, licenses, merkle, mixing, quality, sharding, simhash, templates, toxicity, warc
from .common import table


def quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def decontam_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item it leaks; documents without leaks have none."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))


def shard_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def mix_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mixed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


def warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def license_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def exact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def embedding_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_pu": quality_pu,
    "op2_decontam_cgk": decontam_cgk,
    "op3_line_templates": line_templates,
    "op4_shard_interleaved": shard_interleaved,
    "op5_mix_thresholds": mix_thresholds,
    "op6_warc_segments": warc_segments,
    "op7_simhash_covering": simhash_covering,
    "op8_toxicity_kernel": toxicity_kernel,
    "op9_license_ngrams": license_ngrams,
    "op10_exact_index": exact_index,
    "op11_conversation_repair": conversation_repair,
    "op12_embedding_pigeonhole": embedding_pigeonhole,
    "op13_merkle_manifest": merkle_manifest,
}

_MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) >> 2 AS hash
    FROM documents
), sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sizes
), summed AS (
    SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
           CAST(coalesce(sum(source_size) OVER before, 0) AS BIGINT) * 3 AS capped, CAST(coalesce(sum(weight) OVER before, 0) AS BIGINT) AS gone
    FROM placed
    WINDOW before AS (ORDER BY source_size * CAST(1.0 AS DOUBLE) / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rated AS (
    SELECT *, CAST(total - capped AS DOUBLE) / CAST(weights - gone AS DOUBLE) AS rate FROM summed
), final AS (
    SELECT max(CASE WHEN rate * weight <= source_size * 3 THEN rate END) AS rate FROM rated
), targets AS (
    SELECT source, source_size, least(CAST(source_size * 3 AS DOUBLE), coalesce(final.rate * weight, CAST(source_size * 3 AS DOUBLE))) AS target
    FROM rated, final
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM targets
), left_over AS (
    SELECT *, greatest(CAST(0 AS DOUBLE), target - times * source_size) AS budget FROM budgets
), values_ AS (
    SELECT source, hash, CAST(sum(size) AS BIGINT) AS words FROM sized GROUP BY source, hash
), running AS (
    SELECT *, CAST(sum(words) OVER (PARTITION BY source ORDER BY hash) AS BIGINT) AS upto FROM values_
), fit AS (
    SELECT r.source, r.hash, r.upto <= b.budget OR (r.upto - r.words <= b.budget AND r.upto - b.budget < b.budget - (r.upto - r.words)) AS taken
    FROM running r JOIN left_over b ON r.source IS NOT DISTINCT FROM b.source
)
SELECT s.doc_id, s.size, b.source_size, b.target,
       CAST(CASE WHEN s.size > 0 THEN s.size * (b.times + CASE WHEN f.taken THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM sized s JOIN left_over b ON s.source IS NOT DISTINCT FROM b.source
JOIN fit f ON s.source IS NOT DISTINCT FROM f.source AND s.hash = f.hash
"""


def _base32(hexadecimal: str) -> str:
    """SQL of the base32 form of 40 hexadecimal digits."""
    digit = lambda at, shift: (
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr({hexadecimal}, {at}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)"
    )
    return " || ".join(digit(1 + 5 * i, shift) for i in range(8) for shift in (15, 10, 5, 0))


_WARC_SQL = f"""
WITH digested AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS d FROM pages
), firsts AS (SELECT d, min(page_id) AS first FROM digested GROUP BY d)
SELECT page_id, payload_bytes, {_base32("g.d")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM digested g JOIN firsts f ON g.d = f.d
"""

_EXACT_SQL = """
WITH digested AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digested GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.text_sha256
FROM digested d JOIN groups g ON d.text_sha256 = g.text_sha256
"""



def _crc32(key: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    octets = f"list_transform(string_split({key}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    one = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: {step})"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda c, b: {one}), 4294967295)"


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _after(kind: str, start: int) -> str:
    """SQL of the best rest for each state, given a turn's role and fault and what follows, as [cost, edits, text]."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    wanted = {0: "u", 1: "u", 2: "a", 3: "u"}
    names = {"u": "user", "a": "assistant"}
    options = []
    for inserted in range(3):
        state, put = start, ""
        for _ in range(inserted):
            put += f"'{names[wanted[state]]}:' || chr(10) || "
            state = after[state, wanted[state]]
        told = "I" * inserted

        def option(cost, letter, text, then, told=told, put=put, inserted=inserted):
            return f"{{'cost': {2 * inserted} + {cost} + f{then}.cost, 'edits': '{told}{letter}' || f{then}.edits, 'said': {put}{text}f{then}.said}}"

        options.append(option("3", "D", "", state))
        extra = "(CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END)"
        for role in "sua":
            if (state, role) in after:
                whole = option(extra, "K", "role || ':' || text || chr(10) || ", after[state, role])
                options.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND {kind} = '{role}' THEN {whole} END")
        role = wanted[state]
        whole = option(f"2 + {extra}", "R", f"'{names[role]}:' || text || chr(10) || ", after[state, role])
        options.append(f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {whole} END")
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


_REST = "{{'cost': {}, 'edits': '{}', 'said': {}}}".format
_CONVERSATION_SQL = f"""
WITH RECURSIVE read AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm
    FROM conversations
), harmed AS (
    SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM read WHERE harm <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
           right(rtrim(text, {_BLANKS}), 1) AS last
    FROM harmed
), faults AS (
    SELECT *, CASE WHEN last = '' THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                   WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
           left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) AS pair,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM placed
), walk AS (
    SELECT DISTINCT conv_id, n AS pos, {_REST(0, "", "''")} AS f0, {_REST(4, "II", "'user:' || chr(10) || 'assistant:' || chr(10)")} AS f1,
           {_REST(2, "I", "'assistant:' || chr(10)")} AS f2, {_REST(0, "", "''")} AS f3
    FROM faults
    UNION ALL
    SELECT w.conv_id, w.pos - 1, {", ".join(f"{_after('left(role, 1)', s)} AS f{s}" for s in range(4))}
    FROM walk w JOIN faults x ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND w.pos = x.pos
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
           count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(f0.cost, 0) AS BIGINT) AS cost,
       coalesce(f0.edits, '') AS audit, sha256(coalesce(left(f0.said, length(f0.said) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = 0
"""

_EMBEDDING_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, row_number() OVER () AS r, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
    SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
    SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), walk(r, s) AS (SELECT r, r FROM v UNION SELECT w.r, l.b FROM walk w JOIN links l ON l.a = w.s),
found AS (SELECT w.r, min(v.vec_id) AS component_id FROM walk w JOIN v ON v.r = w.s GROUP BY w.r)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, component_id,
       v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN found ON found.r = v.r
"""


def _encoded(*fields: str) -> str:
    texts = [f"CAST({f} AS VARCHAR)" for f in fields]
    return " || ".join(f"coalesce(CAST(octet_length(encode({t})) AS VARCHAR) || ':' || {t}, '-')" for t in texts)


def _tree(name: str, leaves: str) -> str:
    """CTE of all nodes of the trees over ``leaves`` (tree, i, n, d): level by level, two children to a parent."""
    return f"""{name}(tree, level, i, n, d) AS (
    SELECT tree, 0, i, n, d FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1
    GROUP BY tree, level, i // 2, n
)"""


_MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, sha256({_encoded("doc_id", "source", "lang", "n_chars", "text")}) AS leaf,
           CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL
                THEN sha256({_encoded("doc_id", "source", "lang", "n_chars + 1", "text")}) END AS altered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM leaves
), feet AS (SELECT tree, i, n, leaf AS d FROM placed),
{_tree("lower_nodes", "feet")},
subroots AS (SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, d FROM lower_nodes WHERE n = 1),
{_tree("upper_nodes", "subroots")},
whole AS (SELECT d AS root FROM upper_nodes WHERE n = 1),
steps AS (
    SELECT p.tree, p.i, m.level, m.i % 2 AS place, m.d AS side FROM placed p
    JOIN lower_nodes m ON m.tree = p.tree AND m.n > 1 AND m.i = xor(p.i >> m.level, 1)
    UNION ALL
    SELECT p.tree, p.i, 64 + m.level, m.i % 2, m.d FROM placed p JOIN upper_nodes m ON m.n > 1 AND m.i = xor(p.tree >> m.level, 1)
), levels AS (
    SELECT tree, level, max(n) AS n FROM lower_nodes WHERE n > 1 GROUP BY tree, level
    UNION ALL SELECT s.i, 64 + u.level, max(u.n) FROM subroots s JOIN upper_nodes u ON u.n > 1 GROUP BY s.i, u.level
), ordered AS (SELECT tree, level, row_number() OVER (PARTITION BY tree ORDER BY level) AS step FROM levels),
fold(tree, i, step, d) AS (
    SELECT tree, i, 0, coalesce(altered, leaf) FROM placed
    UNION ALL
    SELECT f.tree, f.i, o.step, sha256(CASE WHEN s.side IS NULL THEN f.d WHEN s.place = 0 THEN s.side || f.d ELSE f.d || s.side END)
    FROM fold f JOIN ordered o ON o.tree = f.tree AND o.step = f.step + 1
    LEFT JOIN steps s ON s.tree = f.tree AND s.i = f.i AND s.level = o.level
), proofs AS (SELECT tree, i, sha256(string_agg(side, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY tree, i),
tops AS (SELECT tree, i, arg_max(d, step) AS folded_root FROM fold GROUP BY tree, i)
SELECT p.doc_id, p.leaf, r.d AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots r ON r.i = p.tree CROSS JOIN whole
JOIN tops t ON t.tree = p.tree AND t.i = p.i LEFT JOIN proofs q ON q.tree = p.tree AND q.i = p.i
"""

ORACLES: dict[str, str] = {
    "op5_mix_thresholds": _MIX_SQL,
    "op6_warc_segments": _WARC_SQL,
    "op10_exact_index": _EXACT_SQL,
    "op11_conversation_repair": _CONVERSATION_SQL,
    "op12_embedding_pigeonhole": _EMBEDDING_SQL,
    "op13_merkle_manifest": _MERKLE_SQL,
}
