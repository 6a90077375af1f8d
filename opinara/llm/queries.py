"""The numbered queries: each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from opinara.llm import ann, decontaminate, langid, lm, mixing, ngram_join, prefix_trie, quality, sharding, simhash, substrings, vector_codes, warc
from opinara.llm.common import learned
from opinara.session import intermediate_path

SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lsa_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = learned("doc_id", 3, 1)
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), learn=~held_out)
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_minhash_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), threshold=0.8, n=5).select("doc_id", "class_id", "n_links")


SQL["op2_minhash_jaccard"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0
), g AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS gram FROM s
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 5 * c >= 4 * (nx.n + ny.n - c)
), r AS (
  SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
), class AS (
  SELECT x AS doc_id, least(x, min(y)) AS class_id FROM r GROUP BY x
), degree AS (
  SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY x
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN class USING (doc_id) LEFT JOIN degree USING (doc_id)
"""


def op3_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = learned("doc_id", 5, 0)
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs, learn=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm.score(docs, lm.fit(docs))


def op5_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


SQL["op5_golden_mix"] = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS ticket
  FROM documents
), w AS (
  SELECT source, source_size, 3 * source_size AS cap,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), r AS (
  SELECT *, (SELECT sum(source_size) FROM w)::BIGINT
              - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS remains,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)
), f AS (
  SELECT *, cap * weights <= remains * weight AS full_ FROM r
), t AS (
  SELECT source, source_size,
         CASE WHEN full_ THEN cap::DOUBLE
              ELSE ((SELECT max(remains) FROM f WHERE NOT full_) * weight)::DOUBLE / (SELECT max(weights) FROM f WHERE NOT full_)
         END AS target
  FROM f
), p AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS goal,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ticket, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0
             ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - start)) END)::BIGINT AS taken
FROM p
"""


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    # the digest is taken before the exchange, which then carries no text
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", crc.alias("text_crc32"))
    return sharding.shard_by_bytes(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


SQL["op6_histogram_shards"] = """
WITH t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
), b AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT doc_id, len(h) // 2 + 16 AS size, substr(md5(text), 1, 16) AS key,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
                         lambda c, v: xor(c // 256, t.crc[xor(c % 256, v) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM b, t
), s AS (
  SELECT doc_id, size, text_crc32, key,
         (coalesce(sum(size) OVER (ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 40
           // (SELECT sum(size) FROM c))::INTEGER AS shard
  FROM c
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s
"""


def op7_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), max_edit=0.2)
    return found.select("doc_id", "item_id", "item_words", "edits", "start", "words")


def op8_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10, recall=0.97)


def op9_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = intermediate_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, min_revisit=1000)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op9_seekable_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keep FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < keep THEN keep END AS refers_to
FROM m
"""


def op10_debruijn_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeated_spans(_table(spark, sf_dir, "documents"), window=20, keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL["op10_debruijn_repeats"] = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM words WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS k FROM starts
), again AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, rank() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows
  ) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS p FROM again)
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""


def op11_active_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"), parts=4, size=256, rounds=4, scale=1024)
    return rows.withColumn("codebooks_sha256", F.lit(vector_codes.fingerprint(books)))


def _lloyd_sql(rounds: int = 4) -> str:
    """Every round as two expressions: the nearest entries and the replaced ones."""
    dist = "(v.s + e.s - 2 * list_inner_product(v.x, e.x))::BIGINT"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT v.part, v.row, arg_min(e.entry, d * 256 + e.entry) AS entry, min(d) AS d
  FROM (SELECT v.part, v.row, e.entry, {dist} AS d FROM v JOIN e{i} e ON e.part = v.part) e GROUP BY v.part, v.row
)""".replace("SELECT v.part, v.row, arg_min(e.entry", "SELECT part, row, arg_min(e.entry").replace("GROUP BY v.part, v.row", "GROUP BY part, row"))
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT a.part, a.entry, p.pos, floor(sum(v.x[p.pos])::BIGINT / count(*)) AS x
  FROM a{i} a JOIN v ON v.part = a.part AND v.row = a.row, (SELECT unnest(range(1, 17)) AS pos) p GROUP BY ALL
), n{i} AS (
  SELECT part, entry, list(x::DOUBLE ORDER BY pos) AS x FROM m{i} GROUP BY ALL
), e{i + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, coalesce(n.x, e.x) AS x, list_inner_product(coalesce(n.x, e.x), coalesce(n.x, e.x)) AS s
  FROM e{i} e LEFT JOIN n{i} n ON n.part = e.part AND n.entry = e.entry
)""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), v AS MATERIALIZED (
  SELECT part, row, x[16 * part + 1:16 * part + 16] AS x, list_inner_product(x[16 * part + 1:16 * part + 16], x[16 * part + 1:16 * part + 16]) AS s
  FROM k, (SELECT unnest(range(4)) AS part)
), e0 AS MATERIALIZED (
  SELECT part, row AS entry, x, s FROM v WHERE row < 256
), {", ".join(steps)}, o AS (
  SELECT row, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row
), t AS (
  SELECT label, sum(error)::BIGINT AS label_error FROM o JOIN k USING (row) GROUP BY label
), h AS (
  SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds}
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM k JOIN o USING (row) JOIN t ON t.label IS NOT DISTINCT FROM k.label, h
"""


SQL["op11_active_lloyd"] = _lloyd_sql()


def op12_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), radius=4, n=4)


# fixed values: the five primes of XXH64
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)


def _simhash_sql(radius: int = 4, n: int = 4, seed: int = 42) -> str:
    """XXH64 over 128-bit integers modulo 2^64, majorities as 64 sums, links by all pairs of fingerprints."""
    whole = 1 << 64
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in _PRIMES)
    mod = lambda x: f"(({x}) % {whole}::UHUGEINT)"
    rot = lambda x, r: f"({mod(f'{x} * {1 << r}::UHUGEINT')} + {x} // {1 << (64 - r)}::UHUGEINT)"
    turn = lambda x, v: mod(f"{rot(mod(f'{x} + {mod(f'{v} * {p2}')}'), 31)} * {p1}")
    number = lambda at, size: "('0x' || " + " || ".join(f"b[2 * ({at}) + {2 * i + 1}:2 * ({at}) + {2 * i + 2}]" for i in reversed(range(size))) + ")::UHUGEINT"
    starts = [(seed + _PRIMES[0] + _PRIMES[1]) % whole, (seed + _PRIMES[1]) % whole, seed, (seed - _PRIMES[0]) % whole]
    lanes = ", ".join(f"list_reduce(list_prepend({s}::UHUGEINT, list_transform(range(size // 32), lambda i: {number(f'32 * i + {8 * k}', 8)})), lambda x, v: {turn('x', 'v')}) AS v{k}"
                      for k, s in enumerate(starts))
    joined = mod(" + ".join(rot(f"v{k}", r) for k, r in enumerate((1, 7, 12, 18))))
    merged = f"list_reduce([{joined}, v0, v1, v2, v3], lambda x, v: {mod(f'xor(x, {turn(0, 'v')}) * {p1} + {p4}')})"
    eights = f"list_reduce(list_prepend(h, list_transform(range(size % 32 // 8), lambda i: {number('size // 32 * 32 + 8 * i', 8)})), lambda x, v: {mod(f'{rot(f'xor(x, {turn(0, 'v')})', 27)} * {p1} + {p4}')})"
    four = f"list_reduce(list_prepend(h, list_transform(range(size % 8 // 4), lambda i: {number('size // 8 * 8', 4)})), lambda x, v: {mod(f'{rot(f'xor(x, {mod(f'v * {p1}')})', 23)} * {p2} + {p3}')})"
    ones = f"list_reduce(list_prepend(h, list_transform(range(size % 4), lambda i: {number('size // 4 * 4 + i', 1)})), lambda x, v: {mod(f'{rot(f'xor(x, {mod(f'v * {p5}')})', 11)} * {p1}')})"
    last = f"list_reduce([h, {1 << 33}::UHUGEINT, {1 << 29}::UHUGEINT, {1 << 32}::UHUGEINT], lambda x, v: {mod(f'xor(x, x // v) * CASE v WHEN {1 << 33}::UHUGEINT THEN {p2} WHEN {1 << 29}::UHUGEINT THEN {p3} ELSE 1 END')})"
    sums = ", ".join(f"sum((h >> {i}) & 1) AS s{i}" for i in range(64))
    bits = " + ".join(f"CASE WHEN 2 * s{i} > n THEN {1 << i}::UHUGEINT ELSE 0 END" for i in range(64))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE r AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT row, w, unnest(range(1, greatest(1, len(w) - {n - 1}) + 1)) AS i FROM r WHERE len(w) > 0
), b AS (
  SELECT row, hex(encode(array_to_string(w[i:i + {n - 1}], ' '))) AS b FROM s
), c AS MATERIALIZED (
  SELECT b, len(b) // 2 AS size, count(*) AS copies FROM b GROUP BY b
), v AS (
  SELECT b, size, {lanes} FROM c
), h1 AS (
  SELECT b, size, ((CASE WHEN size >= 32 THEN {merged} ELSE {(seed + _PRIMES[4]) % whole}::UHUGEINT END) + size::UHUGEINT) % {whole}::UHUGEINT AS h FROM v
), h2 AS (
  SELECT b, size, {eights} AS h FROM h1
), h3 AS (
  SELECT b, size, {four} AS h FROM h2
), h4 AS (
  SELECT b, {ones} AS h FROM h3
), h5 AS MATERIALIZED (
  SELECT b, ({last})::UBIGINT AS h FROM h4
), votes AS (
  SELECT row, count(*) AS n, {sums} FROM b JOIN h5 USING (b) GROUP BY row
), f AS MATERIALIZED (
  SELECT row, doc_id, coalesce({bits}, 0)::UBIGINT AS fp FROM r LEFT JOIN votes USING (row)
), d AS MATERIALIZED (
  SELECT fp, min(doc_id) AS first FROM f GROUP BY fp
), l AS MATERIALIZED (
  SELECT x.fp AS a, y.fp AS b FROM d x JOIN d y ON bit_count(xor(x.fp, y.fp)) <= {radius}
), g AS (
  SELECT a, b FROM l UNION SELECT g.a, l.b FROM g JOIN l ON l.a = g.b
), m AS (
  SELECT g.a AS fp, min(d.first) AS component_id FROM g JOIN d ON d.fp = g.b GROUP BY g.a
)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id FROM f JOIN m USING (fp)
"""


SQL["op12_multi_index_simhash"] = _simhash_sql()


def op13_splitter_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.build_trie(prefix_trie.with_shared_openings(turns, block=100, longest=6))


SQL["op13_splitter_skeleton"] = """
WITH t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii((conv_id::VARCHAR)[i + 1])::BIGINT)),
                         lambda c, v: xor(c // 256, t.crc[xor(c % 256, v) + 1])), 4294967295::BIGINT) % 6 AS h
  FROM own, t
), r AS MATERIALIZED (
  SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN own b ON b.conv_id = h.base
), p AS (
  SELECT conv_id, len(turns) AS n, turns, unnest(range(len(turns) + 1)) AS depth FROM r
), m AS MATERIALIZED (
  SELECT conv_id, n, depth, md5(turns[1:depth]::VARCHAR || chr(1) || depth) AS node, md5(turns[1:depth - 1]::VARCHAR || chr(1) || (depth - 1)) AS up,
         CASE WHEN depth = 0 THEN 0 ELSE length(turns[depth].text) END AS chars
  FROM p
), g AS MATERIALIZED (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, CASE WHEN min(depth) > 0 THEN min(up) END AS up, count(*) AS n_convs,
         (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM m GROUP BY node
), c AS (
  SELECT up AS node, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up
), s AS (
  SELECT a.node, count(*) FILTER (c.node IS NULL) AS n_leaves, sum(g.saved) AS saved_tokens
  FROM g LEFT JOIN c ON c.node = g.node JOIN m a ON a.conv_id = g.conv_id AND a.depth <= g.depth GROUP BY a.node
)
SELECT g.conv_id::BIGINT AS conv_id, g.depth::BIGINT AS depth, u.conv_id::BIGINT AS parent_conv_id, g.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, g.ends_sha256
FROM g JOIN s USING (node) LEFT JOIN c USING (node) LEFT JOIN g u ON u.node = g.up
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = {name: fn for name, fn in globals().items() if name.startswith("op") and name[2:3].isdigit()}
    return numbered | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
