"""The registered queries of the operators, and their DuckDB equivalents where SQL can express them."""

import hashlib
import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import ann, chat, leaks, licences, lines, neardup, packing, pages, periodic, pivots, quality, repair, toxicity
from lakerisk.llm.common import held_out, stored, table

PROBE = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe -7, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    chats = chat.format_chats(rows.unionByName(probe))
    read = chats.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM said
), sized AS (
    SELECT *,
        length(replace(replace(replace(text, '\', '\b'), '</turn>', '\t'), '###', '\h')) AS escaped,
        length(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\t'), '###', '\h'), ':', '\c')) AS named
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
    CAST(sum(escaped + 7 + CASE WHEN before IS NULL OR before <> role THEN named + 7 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = ann.build_index(rows)
    return ann.search(index, index.where(F.col("vec_id") % 50 == 0).select("vec_id", "vector"), k=5)


OP9_SQL = """
WITH sound AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))) AS score
    FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of the kept text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), first AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
    SELECT k.doc_id, k.line, k.place, coalesce(k.doc_id <> f.keeper, false) AS gone
    FROM keyed k LEFT JOIN first f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("found")


def _op6_sql() -> str:
    listed = [(label, text, True) for label, text in licences.PHRASES] + [(label, text, False) for label, text in licences.NOTICES]
    values = ",\n".join(f"({i}, '{label}', '{text}', {phrase})" for i, (label, text, phrase) in enumerate(listed))
    split = "list_filter(string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
    return f"""
WITH listed(template, label, body, phrase) AS (VALUES {values}),
t AS (SELECT *, {split.format("body")} AS w FROM listed),
grams AS (
    SELECT template, label, phrase, len(w) - 1 AS n_pairs, unnest(range(len(w) - 1)) AS slot, w FROM t
), d AS (
    SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents
), placed AS (
    SELECT doc_id, w, unnest(range(len(w) - 1)) AS place FROM d
), hits AS (
    SELECT DISTINCT doc_id, template, label, phrase, n_pairs, slot, place FROM placed p
    JOIN grams g ON p.w[place + 1] = g.w[slot + 1] AND p.w[place + 2] = g.w[slot + 2]
), diagonals AS (
    SELECT doc_id, template, label, phrase, n_pairs, place - slot AS diagonal, list(slot) AS met,
        min(place) AS b, max(place) AS s FROM hits GROUP BY ALL
), stepped AS (
    SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS step FROM diagonals
), runs AS (
    SELECT *, sum(CASE WHEN NOT phrase AND step <= {licences.GAP} THEN 0 ELSE 1 END)
        OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM stepped
), merged AS (
    SELECT doc_id, template, label, phrase, n_pairs, run, len(list_distinct(flatten(list(met)))) AS n_met,
        max(len(met)) AS most, min(b) AS b, max(s) AS s, min(diagonal) AS start FROM runs GROUP BY ALL
), covered AS (
    SELECT *, (CASE WHEN s - b + 1 <= n_pairs * CAST({licences.SLACK} AS DOUBLE) THEN n_met ELSE most END)
        / CAST(n_pairs AS DOUBLE) AS cover FROM merged
), sound AS (
    SELECT * FROM covered WHERE CASE WHEN phrase THEN cover = 1 ELSE cover >= CAST({licences.COVER} AS DOUBLE) END
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, count(template) FILTER (phrase) AS n_base,
    min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (phrase))), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (label IS NOT NULL))), ','), '') AS labels,
    coalesce(max(cover), 0.0) AS score
FROM d LEFT JOIN sound USING (doc_id) GROUP BY d.doc_id, len(d.w)
"""


OP6_SQL = _op6_sql()


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), placed AS (
    SELECT doc_id, w, unnest(range(greatest(len(w) - 4, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END))) AS i FROM d
), grams AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(list_slice(w, i + 1, i + 5), ' ') END AS gram FROM placed
), sizes AS (
    SELECT d.doc_id, count(g.gram) AS n FROM d LEFT JOIN grams g USING (doc_id) GROUP BY d.doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id AS a, doc_id AS r FROM d
    UNION SELECT w.a, reached.r FROM reached JOIN both_ways w ON w.b = reached.a
), smallest AS (
    SELECT a, min(r) AS r FROM reached GROUP BY a
)
SELECT doc_id, n AS n_shingles, r AS component_id, doc_id = r AS kept FROM sizes JOIN smallest ON a = doc_id
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = quality.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a benchmark item in a document, with its words and edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", F.inline("hits"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with made faults, by the CRC-32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(named.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.withColumn("_kind", kind).where("_kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digests(batches):
    """SHA-256 over ``role:text`` of each conversation's turns, joined by newlines, as they pass by."""
    key, digest = None, None
    done = []
    for batch in batches:
        for conv, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
            if place == 0:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = conv, hashlib.sha256()
            digest.update(f"{'' if place == 0 else chr(10)}{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.string()))], names=["conv_id", "repaired_sha256"])
            done = []
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired turns of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    damaged = damage(rows)
    audits = stored(repair.audit(damaged), "audits")
    digests = repair.repaired(damaged, audits).mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    ids = rows.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = ids.join(audits, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(digests, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


OP11_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT i AS byte, 0 AS step, i AS c FROM range(256) r(i)
    UNION ALL SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8
), crc AS (
    SELECT list(c ORDER BY byte) AS t FROM steps WHERE step = 8
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
        substr(role, 1, 1) AS r, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), judged AS (
    SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(r) OVER (PARTITION BY conv_id ORDER BY place) AS r0 FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (place > 1 AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS n FROM judged GROUP BY conv_id
), moves(edit, initial, before, after, price, writes) AS (
    VALUES ('D', '', '', '', 3, ''), ('D', '', 's', 's', 3, ''), ('D', '', 'u', 'u', 3, ''), ('D', '', 'a', 'a', 3, ''),
        ('K', 's', '', 's', 0, '='), ('K', 'u', '', 'u', 0, '='), ('K', 'u', 's', 'u', 0, '='), ('K', 'u', 'a', 'u', 0, '='), ('K', 'a', 'u', 'a', 0, '='),
        ('R', '', '', 'u', 2, 'user'), ('R', '', 's', 'u', 2, 'user'), ('R', '', 'a', 'u', 2, 'user'), ('R', '', 'u', 'a', 2, 'assistant')
), inserts(before, after, price, letters, writes) AS (
    VALUES ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
        ('', 'u', 2, 'I', chr(10) || 'user:'), ('s', 'u', 2, 'I', chr(10) || 'user:'), ('a', 'u', 2, 'I', chr(10) || 'user:'), ('u', 'a', 2, 'I', chr(10) || 'assistant:'),
        ('', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), walk AS (
    SELECT conv_id, 0::BIGINT AS place, '' AS state, 0::BIGINT AS cost, '' AS audit, '' AS written FROM counted
    UNION ALL
    SELECT conv_id, place, state, (best).cost, (best).audit, (best).written FROM (
        SELECT w.conv_id, j.place, m.after AS state, min({
            'cost': w.cost + i.price + m.price + CASE WHEN m.edit <> 'D' AND j.fault = 't' THEN 1 ELSE 0 END,
            'audit': w.audit || i.letters || m.edit,
            'written': w.written || i.writes || CASE WHEN m.edit = 'D' THEN '' ELSE chr(10) || CASE WHEN m.edit = 'K' THEN j.role ELSE m.writes END || ':' || j.text END}) AS best
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
        JOIN inserts i ON i.before = w.state JOIN moves m ON m.before = i.after
        WHERE (m.edit = 'D' OR j.fault NOT IN ('b', 'd')) AND (m.edit <> 'K' OR m.initial = j.r)
        GROUP BY w.conv_id, j.place, m.after)
), ended AS (
    SELECT w.conv_id, min({'cost': w.cost + i.price, 'audit': w.audit || i.letters, 'written': w.written || i.writes}) AS best
    FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place JOIN inserts i ON i.before = w.state
    WHERE i.after IN ('', 'a') GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce((e.best).cost, 0) AS cost,
    coalesce((e.best).audit, '') AS audit, sha256(coalesce((e.best).written[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts gets a periodic end, by the CRC-32 of the id; a row without an id stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    repeats = -(-(n - a) // period)
    return words[:a] + (words[a:a + period] * repeats)[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, a tenth of them with a planted one, and its text without repeats."""
    found = periodic.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted)
    # by length / period, compared without a division
    ahead = lambda a, b: F.when(a["length"] * b["period"] > b["length"] * a["period"], -1).when(
        a["length"] * b["period"] < b["length"] * a["period"], 1).when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).otherwise(F.signum(a["period"] - b["period"]).cast("int"))
    best = F.get(F.array_sort("runs", ahead), F.lit(0))
    listed = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and the component of every vector."""
    return pivots.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP13_SQL = """
WITH RECURSIVE sound AS (
    SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.row <> b.row AND len(a.v) = len(b.v)
    WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95
), reached AS (
    SELECT vec_id AS a, vec_id AS r FROM embeddings
    UNION SELECT l.a, reached.r FROM reached JOIN links l ON l.b = reached.a
), smallest AS (
    SELECT a, min(r) AS r FROM reached GROUP BY a
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, s.r AS component_id, e.vec_id = s.r AS kept
FROM embeddings e JOIN smallest s ON s.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_html_extraction": op2_html_extraction,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_license_scan": op6_license_scan,
    "op7_benchmark_leaks": op7_benchmark_leaks,
    "op8_line_dedup": op8_line_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}
ORACLES = {
    "op1_chat_formatting": OP1_SQL,
    "op3_minhash_near_dedup": OP3_SQL,
    "op6_license_scan": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_nearest_neighbours": OP9_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_embedding_near_dedup": OP13_SQL,
}
