"""Queries on texts, metadata and identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import metadata
from ..sources import extracted, sinks
from .registry import Registry
from .standins import table

REGISTRY = Registry()
query = REGISTRY.query


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


#: Characters around which the cleaning is shown, as the texts have none of them.
DIRT, DIRT_SQL = "\u00b6\u00ad \x01\t\n\n\n\nx  y", "chr(182) || chr(173) || ' ' || chr(1) || chr(9) || repeat(chr(10), 4) || 'x  y'"
SPACE = r"[ \t\n\r\f\v]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT doc_id, sha256({_strip(f"regexp_replace(regexp_replace(regexp_replace(replace(replace(text || {DIRT_SQL}, chr(182), ' '), chr(173), ''), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', ' ', 'g'), '[ \\t]+', ' ', 'g')")}) cleaned FROM documents")
def clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(text.clean_text(F.concat("text", F.lit(DIRT))), 256).alias("cleaned"))


@query(f"WITH c AS (SELECT doc_id, {_strip(f"regexp_replace(regexp_replace(regexp_replace(replace(replace(text || {DIRT_SQL}, chr(182), ' '), chr(173), ''), '[\\r\\n\\t]+', ' ', 'g'), ' {{2,}}', ' ', 'g'), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g')")} t FROM documents) SELECT doc_id, CASE WHEN length(t) > 500 THEN left(t, 497) || '…' ELSE t END cell FROM c")
def clean_cell(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.clean_cell(F.concat("text", F.lit(DIRT))).alias("cell"))


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text || chr(10) || '12345' || chr(10) || '7', chr(10)), lambda x: {_strip("x")}), lambda x: length(x) < 3 OR length(regexp_replace(x, '[^\\p{{L}}]', '', 'g')) >= 2) k FROM documents)
SELECT doc_id, sha256({_strip("regexp_replace(regexp_replace(regexp_replace(array_to_string(k, chr(10)), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '[ \\t]{2,}', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")}) cleaned FROM l""")
def clean_ocr(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(text.clean_ocr(F.concat("text", F.lit("\n12345\n7"))), 256).alias("cleaned"))


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) p, generate_subscripts(string_split(text, chr(10)), 1) i FROM documents),
k AS (SELECT doc_id, p, i, lower({_strip("regexp_replace(p, '\\s+', ' ', 'g')")}) k FROM p), f AS (SELECT * FROM k WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY i) = 1)
SELECT d.doc_id, sha256(coalesce(string_agg(p, chr(10) || chr(10) ORDER BY i), '')) deduped FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""")
def dedup_paragraphs(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2(text.dedup_paragraphs(F.col("text"), "\n"), 256).alias("deduped"))


@query(f"SELECT doc_id, sha256(CASE WHEN starts_with(lower({_strip('text')}), lower({_strip('t')})) THEN text ELSE t || chr(10) || chr(10) || text END) prefixed FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN lower(left(text, 12)) ELSE source END t FROM documents)")
def section_prefix(spark, sf_dir):
    title = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.lower(F.left("text", F.lit(12)))).otherwise(F.col("source"))
    return _docs(spark, sf_dir).select("doc_id", F.sha2(text.with_section(F.col("text"), title), 256).alias("prefixed"))


@query("SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INTEGER) tokens FROM documents")
def token_estimate(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


def _last(what: str) -> str:
    return f"(CASE WHEN contains(h, {what}) THEN length(h) - strpos(reverse(h), reverse({what})) - length({what}) + 1 ELSE -1 END)"


@query(f"""WITH t AS (SELECT doc_id, text, left(text, 1200) h FROM documents), c AS (SELECT doc_id, text, h, {_last('chr(10) || chr(10)')} b, greatest({_last("'. '")}, {_last("'.' || chr(10)")}) s FROM t)
SELECT doc_id, CASE WHEN greatest(1, length(text) // 4) <= 300 THEN text ELSE {_strip("CASE WHEN b > 840 THEN left(h, b) WHEN s > 600 THEN left(h, s + 1) ELSE h END")} END kept FROM c""".replace("1200 * 0.7", "840"))
def truncate_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.truncate_tokens(F.col("text"), 300).alias("kept"))


@query("SELECT doc_id, sha256(CAST(doc_id AS VARCHAR) || '::chunk::' || printf('%06d', n_chars)) chunk_id, sha256(replace('\\\\nas\\x\\' || source, '\\', '/')) path_id, CASE WHEN doc_id % 2 = 0 THEN 'file:////nas/' || source ELSE 'file:///C:/' || source END url FROM documents")
def chunk_ids(spark, sf_dir):
    path = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(F.lit("\\\\nas\\"), "source")).otherwise(F.concat(F.lit("C:\\"), "source"))
    share = text.path_slashes(F.concat(F.lit("\\\\nas\\x\\"), "source"))
    return _docs(spark, sf_dir).select("doc_id", text.chunk_id(F.col("doc_id").cast("string"), F.col("n_chars")).alias("chunk_id"), text.path_id(share).alias("path_id"), text.file_url(path).alias("url"))


RULES = {
    "licence": {"method": "regex", "pattern": r"[Ll]icensed under the ([A-Z][A-Za-z ]+)"},
    "token": {"method": "regex", "pattern": r"token = \"[0-9a-f]{8}"},
    "title": {"method": "label", "label": "Title"},
    "kind": {"method": "constant", "value": "text"},
}


@query(f"""WITH t AS (SELECT doc_id, left(CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || '  title:  A ' || source || '  ' ELSE text END, 250000) x FROM documents),
f AS (SELECT doc_id, nullif({_strip("regexp_extract(x, '[Ll]icensed under the ([A-Z][A-Za-z ]+)', 1)")}, '') licence, nullif({_strip("regexp_extract(x, 'token = \"[0-9a-f]{8}', 0)")}, '') token, nullif({_strip("regexp_extract(x, '(?im)^\\s*Title\\s*[:#\\-]\\s*(.+?)\\s*$', 1)")}, '') title FROM t)
SELECT *, 'text' kind FROM f""")
def metadata_rules(spark, sf_dir):
    changed = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat("text", F.lit("\n  title:  A "), "source", F.lit("  "))).otherwise(F.col("text"))
    got = _docs(spark, sf_dir).select("doc_id", metadata.fields(changed, RULES).alias("m"))
    return got.select("doc_id", *(F.col("m")[k].alias(k) for k in RULES))


@query("SELECT CAST(conv_id AS VARCHAR) doc_id, sha256(string_agg(CAST(turn + 1 AS VARCHAR) || chr(0) || text || chr(0), '' ORDER BY turn)) source_hash, 'db://conversations/' || conv_id file_path, CAST(count(*) AS INTEGER) pages FROM conversations GROUP BY conv_id")
def content_fingerprint(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("page", F.col("turn") + 1)
    got = extracted.documents(rows, {"doc_id": "conv_id", "text": "text", "page": "page", "position": "turn"}, "conversations")
    return got.select("doc_id", "source_hash", "file_path", F.size("pages").alias("pages"))


@query("SELECT DISTINCT conv_id doc_id FROM conversations WHERE conv_id IS NOT NULL ORDER BY 1 LIMIT 50")
def document_ids(spark, sf_dir):
    return extracted.document_ids(table(spark, sf_dir, "conversations"), "conv_id", 50)


@query("SELECT CAST(doc_id AS VARCHAR) doc_id, CASE WHEN regexp_matches(ltrim(s, ' ' || chr(9)), '^[=+\\-@]') THEN '''' || s ELSE s END cell FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '  =' || source WHEN 1 THEN '-' || source WHEN 2 THEN source ELSE '' END s FROM documents)")
def csv_guard(spark, sf_dir):
    m = F.pmod("doc_id", F.lit(4))
    cell = F.when(m == 0, F.concat(F.lit("  ="), "source")).when(m == 1, F.concat(F.lit("-"), "source")).when(m == 2, F.col("source"))
    return sinks.safe_csv(_docs(spark, sf_dir).select("doc_id", cell.alias("cell")))


@query("SELECT coalesce(t.doc_id, n.doc_id) doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.text ELSE t.text END AS text, CASE WHEN t.doc_id IS NOT NULL THEN t.source ELSE n.source END source FROM (SELECT doc_id, text, source FROM documents WHERE doc_id % 3 <> 0) t FULL JOIN (SELECT doc_id, 'new ' || text AS text, 'new' source FROM documents WHERE doc_id % 2 = 0) n ON t.doc_id = n.doc_id")
def upsert_chunks(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "text", "source")
    new = docs.where(F.pmod("doc_id", F.lit(2)) == 0).select("doc_id", F.concat(F.lit("new "), "text").alias("text"), F.lit("new").alias("source"))
    return sinks.upsert(docs.where(F.pmod("doc_id", F.lit(3)) != 0), new, ["doc_id"], ["text"])


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id % 4 <> 0 UNION ALL SELECT conv_id, turn, 'new' FROM conversations WHERE conv_id % 4 = 0 AND turn < 2")
def replace_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    fresh = rows.where((F.pmod("conv_id", F.lit(4)) == 0) & (F.col("turn") < 2)).withColumn("role", F.lit("new"))
    return sinks.replace_documents(rows, fresh, ["conv_id"])
