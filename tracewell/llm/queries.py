"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import (
    branches,
    contextmix,
    derivatives,
    fingerprints,
    hostarray,
    importance,
    ledger,
    manifest,
    mixture,
    ppm,
    snapshots,
    tiling,
    toccurrence,
)
from tracewell.llm.shared import bounded_batches, fold, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def language_model(documents: DataFrame) -> ppm.Model:
    return ppm.train(documents.filter(fold("doc_id", 5) != 0), "text", "lang", F.col("doc_id"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_model(documents)
    return ppm.predict(documents.select("doc_id", "text"), model, "text").select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.bits_per_byte").alias("bits_per_byte"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as a history of one version per path, against a new ledger."""
    found = ledger.scan_history(table(spark, sf_dir, "documents"), "doc_id", "text", shared_folder(spark, "ledger"))
    return found.select(
        F.col("path").alias("doc_id"), *(ledger.count("findings", kind).alias(f"n_{kind}") for kind in ledger.BASE),
        F.sha2(ledger.digest("findings", ledger.BASE), 256).alias("base_sha256"), ledger.digest("findings").alias("spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the tiles (item word, document word, words)."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text") \
        .select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "item_words", "covered", "coverage", "tiles")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.collapse_and_render(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").select(
        F.col("conv").alias("conv_id"), "part", F.col("n").alias("n_turns"), "copies", "rendered")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    mixed, sizes, targets = mixture.mix(
        documents.select("doc_id", "text", "source"), "doc_id", mixture.word_count("text"), F.array("source"))
    sources = spark.createDataFrame([(s, sizes[s], float(targets[s])) for s in sizes],
                                    "_source string, source_size long, target double")
    return mixed.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.col("_taken").alias("taken"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    return contextmix.scores(documents, "doc_id", "text", ~held_out).withColumnRenamed("key", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostarray.main_text(table(spark, sf_dir, "pages"), "page_id", "url", "html").select(
        F.col("key").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    responses = derivatives.responses_from_pages(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z")
    return derivatives.build(responses).withColumn("page_id", F.col("source").cast("long")).select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length", "block_digest",
        "source_payload_digest", "header", "content")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toccurrence.jaccard_components(
        table(spark, sf_dir, "documents"), "doc_id", "text", size=3, at_least=90, of=100).select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resampled(documents, "doc_id", "text", benchmark, "text").select(
        F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = branches.compared(table(spark, sf_dir, "documents"), "doc_id", "text")
    spans = F.transform("edits", lambda s: F.concat(s["start"], F.lit("-"), s["stop"]))
    return prints.select(
        F.col("key").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", F.col("edited_print").alias("edited_fingerprint"), "near_edited", "near_next",
        F.col("next_key").alias("next_id"), F.array_join(spans, ",").alias("edits"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the table; some rows are checked as if ``n_chars`` had been changed."""
    documents = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [column + 1 if i == 3 else column for i, column in enumerate(columns)]
    probe = F.when(fold("doc_id", 7) == 0, manifest.leaf(changed))
    proved = manifest.manifest(documents, "doc_id", "lang", columns, probe)
    proof = F.col("proof")
    folded = manifest.fold(F.coalesce("probe", "leaf"), proof)
    return proved.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(manifest.proof_text(proof), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontamination": op3_decontamination,
    "op4_chat_format": op4_chat_format,
    "op5_source_mix": op5_source_mix,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_html_extraction": op8_html_extraction,
    "op9_warc_derivatives": op9_warc_derivatives,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def crc32_sql(value: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, bit by bit: DuckDB has no such function."""
    byte = f"CAST('0x' || substr(hex(encode({value})), 2 * i + 1, 2) AS BIGINT)"
    steps = f"flatten(list_transform(range(octet_length(encode({value}))), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, b: xor(xor(c, b) >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), {step}), 4294967295)"


def words_sql(text: str) -> str:
    """Words of digits, a-z and all but ASCII, after lower-casing A-Z."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(field_sql(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def tree_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, pos, h), level by level."""
    return f"""{name}(tree, level, pos, h) AS (
        SELECT tree, 0, pos, h FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, level, pos // 2)"""


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    # Turns of a conversation as a list; the lists of their beginnings are looked for among the others.
    "op4_chat_format": """
        WITH logged AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns
                        FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations) GROUP BY conv_id),
             begun AS (SELECT DISTINCT turns[1:k] AS turns FROM logged, unnest(range(1, len(turns))) AS r(k)),
             whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS copies FROM logged GROUP BY turns),
             kept AS (SELECT * FROM whole WHERE turns NOT IN (SELECT turns FROM begun)),
             placed AS (SELECT conv_id, len(turns) AS n_turns, copies, unnest(turns) AS turn, unnest(range(len(turns))) AS place FROM kept)
        SELECT conv_id, place // 256 AS part, n_turns, copies,
               string_agg('<|im_start|>' || turn.role || chr(10) || turn.text || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
        FROM placed GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY conv_id, place // 256, n_turns, copies"),
    "op11_importance_resampling": f"""
        WITH said AS (SELECT doc_id, row_number() OVER () AS row, {words_sql("text")} AS words FROM documents),
             own AS (SELECT row, unnest(words) AS word FROM said),
             aimed AS (SELECT unnest({words_sql("text")}) AS word FROM benchmark),
             buckets AS (SELECT word, {crc32_sql("word")} % 10000 AS bucket FROM (SELECT word FROM own UNION SELECT word FROM aimed)),
             source AS (SELECT bucket, count(*) AS s FROM own JOIN buckets USING (word) GROUP BY bucket),
             target AS (SELECT bucket, count(*) AS t FROM aimed JOIN buckets USING (word) GROUP BY bucket),
             gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM own) + 10000 AS DOUBLE)
                              / (CAST(s + 1 AS DOUBLE) * CAST((SELECT count(*) FROM aimed) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
                       FROM source LEFT JOIN target USING (bucket)),
             means AS (SELECT row, CAST(sum(gain) AS BIGINT) AS total, count(*) AS n
                       FROM own JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row),
             weights AS (SELECT doc_id, coalesce(n, 0) AS n_features, len(words) AS n_words,
                                coalesce((total - ((total % n) + n) % n) // n, 0) AS weight,
                                CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
                         FROM said LEFT JOIN means USING (row)),
             scores AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weights),
             ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
                       FROM scores WHERE n_words >= 20)
        SELECT s.doc_id, n_features, weight, score, rank
        FROM scores s LEFT JOIN (SELECT * FROM ranks WHERE rank <= 10 * n // 100) r ON r.doc_id = s.doc_id""",
    # Trees line by line; likeness level by level, from counts of equal tokens; edits as runs of lines.
    "op12_document_fingerprints": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             linked AS (SELECT doc_id, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text,
                               coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id
                        FROM docs WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, sha256(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || text))),
             edited AS (SELECT *, left(text, length(text) - length(text) // 3) || left(next_text, length(text) // 3) AS edited FROM linked),
             texts AS (SELECT row_number() OVER () AS t, text FROM (SELECT text FROM edited UNION SELECT edited FROM edited)),
             lines AS (SELECT t, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM texts),
             hashed AS (SELECT t, i, sha256(line) AS digest, length(line) + 1 AS size,
                               list_transform(regexp_extract_all(line || chr(10), '{branches.PIECE.replace(chr(92) + 'n', chr(10))}'),
                                              lambda p: substr(md5(p), 1, 8) || length(p)) AS pieces FROM lines),
             paragraphs AS (SELECT t, i, digest, size, substr(digest, 1, 16) || size || '-' || array_to_string(pieces, '.') AS token,
                                   coalesce(sum(CASE WHEN substr(digest, 64, 1) < '4' THEN 1 ELSE 0 END)
                                            OVER (PARTITION BY t ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS section,
                                   coalesce(sum(size) OVER (PARTITION BY t ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
                            FROM hashed),
             sections AS (SELECT t, section, sha256(string_agg(digest, '' ORDER BY i)) AS digest, sum(size) AS size,
                                 string_agg(token, ',' ORDER BY i) AS inner_ FROM paragraphs GROUP BY t, section),
             named AS (SELECT t, section, digest, size, substr(digest, 1, 16) || CAST(size AS BIGINT) || '=' || inner_ AS token FROM sections),
             prints AS (SELECT t, sha256(string_agg(digest, '' ORDER BY section)) || '/' || string_agg(token, ';' ORDER BY section) AS print
                        FROM named GROUP BY t),
             ids AS (SELECT e.*, a.t AS own, b.t AS changed, c.t AS follows FROM edited e JOIN texts a ON a.text = e.text
                     JOIN texts b ON b.text = e.edited JOIN texts c ON c.text = e.next_text),
             pairs AS (SELECT own AS x, changed AS y FROM ids UNION SELECT own, follows FROM ids),
             one AS (SELECT x, y, token, count(*) FILTER (t = x) AS n, count(*) FILTER (t = y) AS m
                     FROM pairs JOIN named ON x <> y AND t IN (x, y) GROUP BY x, y, token),
             two AS (SELECT x, y, unnest(string_split(split_part(token, '=', 2), ',')) AS token, n - least(n, m) AS n, m - least(n, m) AS m FROM one WHERE n <> m),
             two_n AS (SELECT x, y, token, sum(n) AS n, sum(m) AS m FROM two GROUP BY x, y, token),
             three AS (SELECT x, y, unnest(string_split(split_part(token, '-', 2), '.')) AS token, n - least(n, m) AS n, m - least(n, m) AS m FROM two_n WHERE n <> m),
             three_n AS (SELECT x, y, token, sum(n) AS n, sum(m) AS m FROM three GROUP BY x, y, token),
             shared AS (SELECT x, y, sum(part) AS shared FROM (
                          SELECT x, y, least(n, m) * CAST(split_part(substr(token, 17), '=', 1) AS BIGINT) AS part FROM one
                          UNION ALL SELECT x, y, least(n, m) * CAST(split_part(substr(token, 17), '-', 1) AS BIGINT) FROM two_n
                          UNION ALL SELECT x, y, least(n, m) * CAST(substr(token, 9) AS BIGINT) FROM three_n) GROUP BY x, y),
             sizes AS (SELECT t, sum(size) AS size FROM sections GROUP BY t),
             alike AS (SELECT x, y, CASE WHEN x = y THEN 1.0::DOUBLE
                              ELSE 2.0::DOUBLE * CAST(shared AS DOUBLE) / CAST(a.size + b.size AS DOUBLE) END AS likeness
                       FROM pairs LEFT JOIN shared USING (x, y) JOIN sizes a ON a.t = x JOIN sizes b ON b.t = y),
             moved AS (SELECT DISTINCT own AS x, changed AS y FROM ids WHERE own <> changed),
             gone AS (SELECT DISTINCT x, y, p.token FROM moved JOIN named s ON s.t = x JOIN paragraphs p ON p.t = s.t AND p.section = s.section
                      WHERE NOT EXISTS (SELECT 1 FROM named o WHERE o.t = y AND o.token = s.token)),
             fresh AS (SELECT x, y, p.i, p.start, p.start + p.size AS stop, p.i - row_number() OVER (PARTITION BY x, y ORDER BY p.i) AS run
                       FROM moved JOIN named s ON s.t = y JOIN paragraphs p ON p.t = s.t AND p.section = s.section
                       WHERE NOT EXISTS (SELECT 1 FROM named o WHERE o.t = x AND o.token = s.token)
                         AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.x = moved.x AND g.y = moved.y AND g.token = p.token)),
             spans AS (SELECT x, y, min(start) AS start, max(stop) AS stop FROM fresh GROUP BY x, y, run),
             located AS (SELECT x, y, string_agg(CAST(start AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY start) AS edits FROM spans GROUP BY x, y)
        SELECT doc_id, length(i.text) AS n_chars, sha256(edited) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint,
               e.likeness AS near_edited, f.likeness AS near_next, next_id, coalesce(l.edits, '') AS edits
        FROM ids i JOIN prints a ON a.t = own JOIN prints b ON b.t = changed JOIN alike e ON e.x = own AND e.y = changed
        JOIN alike f ON f.x = own AND f.y = follows LEFT JOIN located l ON l.x = own AND l.y = changed""",
    # Levels one after the other; then each row's way up through its group's tree and the groups' tree.
    "op13_merkle_manifest": f"""
        WITH RECURSIVE
             leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
                        FROM (SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf_sql("n_chars")} AS h,
                                     CASE WHEN {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 7 = 0
                                          THEN {leaf_sql("n_chars + 1")} END AS probe FROM documents)),
             {tree_sql("nodes", "leaves")},
             subroots AS (SELECT tree AS member, arg_max(h, level) AS h, max(level) AS height, '' AS tree,
                                 row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes GROUP BY nodes.tree),
             {tree_sql("tops", "subroots")},
             steps AS (SELECT l.tree, l.pos, r.level, sibling.h AS sibling, (l.pos >> r.level) % 2 = 1 AS on_left
                       FROM leaves l JOIN subroots s ON l.tree = s.member, unnest(range(s.height)) AS r(level)
                       LEFT JOIN nodes sibling ON sibling.tree = l.tree AND sibling.level = r.level AND sibling.pos = xor(l.pos >> r.level, 1)
                       UNION ALL
                       SELECT l.tree, l.pos, s.height + r.level, sibling.h, (s.pos >> r.level) % 2 = 1
                       FROM leaves l JOIN subroots s ON l.tree = s.member, unnest(range((SELECT max(level) FROM tops))) AS r(level)
                       LEFT JOIN tops sibling ON sibling.level = r.level AND sibling.pos = xor(s.pos >> r.level, 1)),
             folded(tree, pos, level, h) AS (
                       SELECT tree, pos, 0, coalesce(probe, h) FROM leaves
                       UNION ALL
                       SELECT f.tree, f.pos, f.level + 1,
                              sha256(CASE WHEN on_left THEN sibling || h ELSE h || coalesce(sibling, '') END)
                       FROM folded f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level),
             proofs AS (SELECT tree, pos, string_agg(sibling, '' ORDER BY level) AS proof FROM steps GROUP BY tree, pos),
             ends AS (SELECT tree, pos, arg_max(h, level) AS folded_root FROM folded GROUP BY tree, pos)
        SELECT doc_id, l.h AS leaf, s.h AS subroot, root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
               folded_root = root.h AS verified
        FROM leaves l JOIN subroots s ON l.tree = s.member JOIN ends e ON e.tree = l.tree AND e.pos = l.pos
        LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos, (SELECT arg_max(h, level) AS h FROM tops) root""",
    "op6_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, {LOWERED} AS body FROM documents) WINDOW same AS (PARTITION BY body)""",
}
