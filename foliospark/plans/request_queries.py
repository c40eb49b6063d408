"""Registered queries: request shaping, ledger states and the figure gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import figures, lanes, ledger, normalize, prompts, requests
from foliospark.operators.validate import REPAIR_END, REPAIR_LINES, repair_instruction
from foliospark.plans import ledger_queries, workflow
from foliospark.plans.registry import query, table
from foliospark.sources import external, readers, sinks

DATE = "2026-01-02"


def _sql(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.expr("concat('e-', doc_id)").alias("custom_id"), "text", "n_chars")


@query("""SELECT '{"custom_id":"e-' || doc_id || '","method":"POST","url":"/v1/responses","body":{"model":"m","max_output_tokens":' || n_chars || ',"instructions":"s","input":[{"role":"user","content":[' ||
  CASE WHEN doc_id % 2 = 0 THEN '{"type":"input_file","file_id":"f' || doc_id || '"},' ELSE '' END || '{"type":"input_text","text":"p ' || doc_id || '"}]}]}}' AS value FROM documents""")
def request_jsonl(spark: SparkSession, d: str) -> DataFrame:
    rows = _docs(spark, d).select("custom_id", F.lit("m").alias("model"), F.col("n_chars").alias("max_tokens"), F.lit("s").alias("system"), F.expr("CASE WHEN doc_id % 2 = 0 THEN concat('f', doc_id) END").alias("file_id"), F.expr("concat('p ', doc_id)").alias("prompt"))
    return sinks.request_lines(rows)


@query(r"""SELECT '{"custom_id":"e-' || doc_id || '","params":{"model":"m","max_tokens":5,"system":[{"type":"text","text":"s","cache_control":{"type":"ephemeral"}}],"messages":[{"role":"user","content":[' || CASE doc_id % 3
  WHEN 0 THEN '{"type":"text","text":"Page content from https://x.org/' || doc_id || ':\n\npage ' || doc_id || '\n\ndo"}' WHEN 1 THEN '{"type":"document","source":{"type":"url","url":"https://x.org/' || doc_id || '"}},{"type":"text","text":"do"}'
  ELSE '{"type":"document","source":{"type":"base64","media_type":"application/pdf","data":"ZGF0YQ=="}},{"type":"text","text":"do"}' END || ']}]}}' AS value FROM documents""")
def batch_requests(spark: SparkSession, d: str) -> DataFrame:
    page, url, data = F.expr("CASE WHEN doc_id % 3 = 0 THEN concat('page ', doc_id) END"), F.expr("CASE WHEN doc_id % 3 < 2 THEN concat('https://x.org/', doc_id) END"), F.expr("CASE WHEN doc_id % 3 = 2 THEN 'ZGF0YQ==' END")
    return requests.batch_payload(_docs(spark, d).select("custom_id", F.lit("m").alias("model"), F.lit(5).alias("max_tokens"), F.lit("s").alias("system"), requests.message_content(page, url, data, F.lit("do")).alias("content")))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Attached file ID: f' || doc_id WHEN 1 THEN 'Paper reference URL: https://x.org/' || doc_id
  ELSE 'Local PDF path: /in/' || doc_id || '.pdf' || chr(10) || 'Read this local PDF file directly from disk and base the analysis only on this source.' END || chr(10) || chr(10) || 'do ' || doc_id AS flat,
  CASE WHEN doc_id % 3 = 0 THEN 'input_file' ELSE 'input_text' END AS first FROM documents""")
def response_requests(spark: SparkSession, d: str) -> DataFrame:
    file, kind = F.expr("CASE WHEN doc_id % 3 = 0 THEN concat('f', doc_id) END"), F.expr("CASE WHEN doc_id % 3 = 1 THEN 'url' ELSE 'local_pdf' END")
    content = requests.response_content(file, kind, F.expr("concat('https://x.org/', doc_id)"), F.expr("concat('/in/', doc_id, '.pdf')"), F.expr("concat('do ', doc_id)"))
    return _docs(spark, d).select("doc_id", content.alias("c")).select("doc_id", requests.flattened(F.col("c")).alias("flat"), F.col("c")[0]["type"].alias("first"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Source URL: u' || doc_id || chr(10) || chr(10) || 'Extracted page text:' || chr(10) || text WHEN 1 THEN 'The paper is at: u' || doc_id ELSE 'Read the PDF at this path: /in/' || doc_id END || chr(10) || chr(10) || 'do' AS prompt FROM documents""")
def local_prompts(spark: SparkSession, d: str) -> DataFrame:
    url = F.expr("CASE WHEN doc_id % 3 < 2 THEN concat('u', doc_id) END")
    return _docs(spark, d).select("doc_id", requests.local_prompt(F.when(F.col("doc_id") % 3 == 0, F.col("text")), url, F.expr("concat('/in/', doc_id)"), F.lit("do")).alias("prompt"))


@query("SELECT page_id, page_id % 2 = 0 AS is_url, CASE WHEN page_id % 2 = 0 THEN 'url' ELSE 'local_pdf' END AS kind, CASE WHEN page_id % 2 = 0 THEN url END AS url, CASE WHEN page_id % 2 = 1 THEN '/in/f' || page_id || '.pdf' END AS file_path FROM pages")
def ledger_inputs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select("page_id", F.expr("CASE WHEN page_id % 2 = 0 THEN url ELSE concat('f', page_id, '.pdf') END").alias("input"))
    return requests.as_inputs(rows, "/in/").select("page_id", "is_url", "source.kind", "source.url", "source.file_path")


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 5 > 0 THEN p.pdf END AS pdf FROM documents d LEFT JOIN (SELECT doc_id // 2 AS k, min('v' || doc_id || '.pdf') AS pdf FROM documents GROUP BY ALL) p ON p.k = d.doc_id""")
def result_pdfs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    name = lambda c: F.concat(F.when(F.col("doc_id") % 5 == 0, "explainer-url-").otherwise("explainer-"), c)
    results = docs.select("doc_id", name(F.col("doc_id").cast("string")).alias("custom_id"))
    own = docs.select(F.expr("doc_id div 2").alias("doc_id"), F.expr("concat('v', doc_id, '.pdf')").alias("filename")).select(name(F.col("doc_id").cast("string")).alias("custom_id"), "filename")
    return requests.source_pdfs(results, own).select("doc_id", "pdf")


_INSTRUCTION = " ".join(x.replace("GUIDE", prompts.GUIDE).replace("{}", DATE) if "metadata" in x else x.replace("GUIDE", prompts.GUIDE) for x in prompts.USER_INSTRUCTION)


@query(f"SELECT doc_id, {_sql(_INSTRUCTION)} || CASE WHEN doc_id % 2 = 0 THEN {_sql(prompts.EMPHASIS[0])} || 'stress ' || doc_id || {_sql(prompts.EMPHASIS[1])} ELSE '' END AS instruction FROM documents")
def user_instructions(spark: SparkSession, d: str) -> DataFrame:
    hint = F.expr("CASE doc_id % 4 WHEN 1 THEN '  ' WHEN 3 THEN null ELSE concat(' stress ', doc_id, '\n') END")
    return table(spark, d, "documents").select("doc_id", prompts.user_instruction(F.lit(DATE), hint).alias("instruction"))


@query(f"SELECT doc_id, {_sql(chr(10).join(REPAIR_LINES).replace('{}', DATE))} || chr(10) || '- first ' || doc_id || chr(10) || '- second' || chr(10) || {_sql(REPAIR_END)} AS instruction FROM documents")
def repair_texts(spark: SparkSession, d: str) -> DataFrame:
    found = F.array(F.expr("concat('first ', doc_id)"), F.lit("second"))
    return table(spark, d, "documents").select("doc_id", repair_instruction(found, DATE).alias("instruction"))


@query("SELECT provider, arg_max(event_id, event_id) AS event_id FROM (SELECT CASE event_id % 3 WHEN 1 THEN 'openai' ELSE 'claude' END AS provider, event_id FROM events WHERE event_id % 5 > 0) GROUP BY provider")
def provider_pending(spark: SparkSession, d: str) -> DataFrame:
    named = F.expr("CASE event_id % 3 WHEN 1 THEN 'openai' WHEN 2 THEN 'claude' END")
    rows = table(spark, d, "events").select("event_id", ledger.provider_of(named).alias("provider"), F.when(F.col("event_id") % 5 > 0, "processing").otherwise("ended").alias("status"), F.col("event_id").alias("seq"))
    return ledger.latest_pending(rows, "seq", "provider").select("provider", "event_id")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 AND doc_id % 3 > 0 THEN 'reuse' ELSE 'upload' END AS action, CASE WHEN doc_id % 4 = 0 AND doc_id % 3 > 0 THEN 'file-' ELSE 'new-' END || doc_id AS file_id FROM documents""", plug_point=True)
def uploads(spark: SparkSession, d: str) -> DataFrame:
    """Files are sent only if the cache has another content or the remote lost them."""
    docs = table(spark, d, "documents")
    inputs = docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    cache = docs.filter("doc_id % 2 = 0").select("doc_id", F.sha2(F.expr("CASE WHEN doc_id % 3 = 0 THEN 'stale' ELSE text END").cast("binary"), 256).alias("sha256"), F.expr("concat('file-', doc_id)").alias("file_id"))
    told = ledger.file_cache_action(inputs, cache, "doc_id", cache.filter("doc_id % 4 = 0"))
    sent = external.apply_tool(told.filter("action = 'upload'").select("doc_id"), lambda row: {"new_id": f"new-{row['doc_id']}"}, ["doc_id"], "new_id string")
    return told.join(sent.select("doc_id", "new_id"), "doc_id", "left").select("doc_id", "action", F.coalesce("file_id", "new_id").alias("file_id"))


@query(f"""WITH s AS ({ledger_queries._STATUS})
SELECT batch_id, n_total || ' total, ' || n_succeeded || ' succeeded, ' || n_errored || ' errored, lanes ' || n_lanes AS explainers, CASE WHEN tokens_in > 0 THEN 'Tokens: ' || format('{{:,}}', tokens_in) || ' input + ' || format('{{:,}}', tokens_out) || ' output' END AS tokens,
  CASE WHEN tokens_in > 0 THEN 'Cost: $' || format('{{:.4f}}', effective_usd / 10000::DOUBLE) || ' (effective), $' || format('{{:.4f}}', standard_usd / 10000::DOUBLE) || ' (standard), saved $' || format('{{:.4f}}', saving_usd / 10000::DOUBLE) END AS cost FROM s""")
def status_lines(spark: SparkSession, d: str) -> DataFrame:
    status = ledger.batch_status(ledger_queries._requests(spark, d), "batch_id")
    return requests.status_report(status.withColumns({c: F.col(c) / 10000 for c in ("effective_usd", "standard_usd", "saving_usd")}))


@query("SELECT user_id AS batch_id, bool_or(event_type IN ('click', 'view')) AS lanes FROM events GROUP BY user_id")
def lane_batches(spark: SparkSession, d: str) -> DataFrame:
    return ledger.lanes_present(ledger_queries._requests(spark, d), "batch_id")


@query("SELECT n_nationkey, lower(coalesce(v, '1')) NOT IN ('0', 'false', 'no') AS on_ FROM (SELECT n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN '0' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'No' WHEN 3 THEN 'yes' WHEN 4 THEN '' END AS v FROM nation)")
def lane_setting(spark: SparkSession, d: str) -> DataFrame:
    value = F.expr("CASE n_nationkey % 6 WHEN 0 THEN '0' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'No' WHEN 3 THEN 'yes' WHEN 4 THEN '' END")
    return table(spark, d, "nation").select("n_nationkey", lanes.enabled(value).alias("on_"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def iso_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", T.iso_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"))


@query("SELECT n_nationkey, 'm-' || CASE WHEN n_nationkey % 2 = 0 THEN 'own' ELSE 'base' END AS model, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey::VARCHAR END AS extra, CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS n FROM nation")
def merged_settings(spark: SparkSession, d: str) -> DataFrame:
    base = F.create_map(F.lit("model"), F.lit("m-base"), F.lit("secret"), F.lit("x"))
    over = F.expr("map_from_arrays(array('model', 'extra'), array(CASE WHEN n_nationkey % 2 = 0 THEN 'm-own' END, CASE WHEN n_nationkey % 3 = 0 THEN cast(n_nationkey as string) END))")
    both = T.without_keys(T.merged(base, over), "secret")
    rows = table(spark, d, "nation").select("n_nationkey", F.map_filter(both, lambda _, v: v.isNotNull()).alias("m"))
    return rows.select("n_nationkey", F.col("m")["model"].alias("model"), F.try_element_at("m", F.lit("extra")).alias("extra"), F.size("m").cast("bigint").alias("n"))


@query("SELECT user_id AS batch_id, CASE WHEN user_id % 3 = 0 THEN 'ended' WHEN user_id % 5 IN (0, 1) THEN 'ended' ELSE 'processing' END AS status FROM (SELECT DISTINCT user_id FROM events)")
def batch_transition(spark: SparkSession, d: str) -> DataFrame:
    users = table(spark, d, "events").select(F.col("user_id").alias("batch_id")).distinct()
    batches = users.select("batch_id", F.when(F.col("batch_id") % 3 == 0, "ended").otherwise("processing").alias("status"))
    state = F.expr("CASE batch_id % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'expired' ELSE 'in_progress' END")
    remote = users.filter("batch_id % 5 < 4").select("batch_id", ledger.remote_status(state, F.lit(3), F.lit(1), F.lit(0)).alias("x")).select("batch_id", "x.status")
    return ledger.ended(batches, remote)


@query("SELECT event_id FROM events WHERE user_id = 7 AND event_id % 5 = 1")
def resumed_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger_queries._requests(spark, d).select(F.col("batch_id").cast("string").alias("batch_id"), "event_id", "result")
    batches = rows.select("batch_id").distinct().withColumn("status", F.when(F.col("batch_id") == "8", "ended").otherwise("processing"))
    found = [ledger.resumed(batches, rows, x).select("event_id") for x in ("7", "8", "none")]
    return found[0].unionAll(found[1]).unionAll(found[2])


@query("SELECT 'e-' || doc_id AS custom_id, 'codexbatch_' || doc_id % 7 AS batch_id, 'do ' || doc_id AS text, 2::BIGINT AS input_tokens, NULL AS error FROM documents WHERE doc_id % 2 = 0", plug_point=True)
def deferred_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.expr("concat('e-', doc_id)").alias("custom_id"), F.expr("concat(CASE WHEN doc_id % 2 = 0 THEN 'codexbatch_' ELSE 'batch_' END, doc_id % 7)").alias("batch_id"), F.lit("s").alias("system"), F.expr("concat('do ', doc_id)").alias("prompt"))
    return workflow.polled(rows, workflow.echo_model).select("custom_id", "batch_id", "text", "input_tokens", "error")


@query("""SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS first, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user'), '') AS every FROM conversations GROUP BY conv_id""")
def text_blocks(spark: SparkSession, d: str) -> DataFrame:
    block = F.struct("turn", F.when(F.col("role") == "user", "text").otherwise("thinking").alias("type"), "text")
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("b"))
    return rows.select("conv_id", readers.first_text(F.col("b")).alias("first"), readers.all_text(F.col("b")).alias("every"))


@query("""SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def streamed_blocks(spark: SparkSession, d: str) -> DataFrame:
    return normalize.joined_blocks(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'raw ' || doc_id WHEN 1 THEN '{"id":' || doc_id || '}' ELSE '' END AS raw FROM documents""")
def chart_texts(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.when(F.col("doc_id") % 3 != 2, F.parse_json(F.expr("""concat('{"id": ', doc_id, '}')""")))
    return table(spark, d, "documents").select("doc_id", normalize.chart_raw(parsed, F.expr("CASE WHEN doc_id % 3 = 0 THEN concat('raw ', doc_id) ELSE '' END")).alias("raw"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN 'Figure ' || doc_id END AS source_figure, CASE WHEN doc_id % 3 = 1 THEN 'told' WHEN doc_id % 3 = 2 THEN CASE WHEN doc_id % 2 = 0 THEN 'own' ELSE 'Figure ' || doc_id || ' from the source paper.' END END AS caption,
  CASE WHEN doc_id % 3 > 0 THEN 'Figure ' || doc_id || ' from the source paper.' END AS alt_text FROM documents""")
def image_blocks(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    override = {"source_figure": F.expr("CASE WHEN doc_id % 3 > 0 THEN concat('Figure ', doc_id) END"), "caption": F.when(F.col("doc_id") % 3 == 1, "told"), "alt_text": none}
    existing = {"caption": F.when(F.col("doc_id") % 2 == 0, "own"), "alt_text": none}
    return table(spark, d, "documents").select("doc_id", normalize.image_block(override, existing).alias("x")).select("doc_id", "x.*")


@query("""WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'no directive' WHEN p_partkey % 4 = 1 THEN 'no PDF' WHEN p_partkey % 3 = 0 THEN 'no crop' WHEN p_partkey % 5 > 0 AND p_size % 2 = 0 THEN 'mostly text' END AS reason FROM part) SELECT p_partkey, reason IS NULL AS kept, reason FROM r""")
def image_gate(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    wanted = part.select("p_partkey", F.when(F.col("p_partkey") % 4 > 0, "Figure 1").alias("source_figure"), F.when(F.col("p_partkey") % 4 != 1, "a.pdf").alias("pdf"))
    crops = part.filter("p_partkey % 3 > 0").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, "embedded").otherwise("vector").alias("tier"))
    return figures.gated_images(wanted, crops, part.select("p_partkey", (F.col("p_size") % 2 == 0).alias("mostly_text")), "p_partkey")


_SCALE = "(150 / 72::DOUBLE)"


@query(f"""WITH c AS (SELECT 'p' || p_partkey AS pdf, CASE WHEN p_partkey % 5 = 0 THEN 'embedded' ELSE 'vector' END AS tier, CASE WHEN p_partkey % 3 = 0 THEN 60 ELSE 124 END::DOUBLE AS y_min, CASE WHEN p_partkey % 3 = 0 THEN 300 + p_size - 4 ELSE 792 END::DOUBLE AS y_max FROM part WHERE p_partkey % 3 < 2)
  SELECT pdf, 1 AS page, tier, y_min, y_max, 0::BIGINT AS x, floor(y_min * {_SCALE})::BIGINT AS y, 1275::BIGINT AS w, ceil((y_max - y_min) * {_SCALE})::BIGINT AS h FROM c""")
def derived_crops(spark: SparkSession, d: str) -> DataFrame:
    """Pages with two lines of text above a caption: a hinted crop is pinned
    between header and caption, a free one lies between the text around it."""
    part = table(spark, d, "part").select(F.expr("concat('p', p_partkey)").alias("pdf"), F.lit(1).alias("page"), "p_partkey", "p_size")
    asks = part.select("pdf", F.when(F.col("p_partkey") % 3 == 2, "no number").otherwise("Fig. 3").alias("label"), F.when(F.col("p_partkey") % 3 == 0, 1).alias("page_hint"))
    pages = part.select("pdf", "page", F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.lit("intro\n Figure 3. A plot").alias("text"))
    words = part.select("pdf", "page", F.explode(F.expr("array(named_struct('seq', 0, 'y', 100D, 'text', 'some'), named_struct('seq', 1, 'y', 112D, 'text', 'words'), named_struct('seq', 2, 'y', 300D + p_size, 'text', 'Figure'), named_struct('seq', 3, 'y', 300D + p_size, 'text', '3.'))")).alias("x"))
    boxed = words.select("pdf", "page", "x.seq", (50.0 + 40 * F.col("x.seq")).alias("x_min"), F.col("x.y").alias("y_min"), (80.0 + 40 * F.col("x.seq")).alias("x_max"), (F.col("x.y") + 10).alias("y_max"), "x.text")
    images = part.filter("p_partkey % 5 = 0").select("pdf", "page", F.lit("image").alias("type"), F.lit(700).alias("width"), F.lit(400).alias("height"))
    return figures.derive_crops(asks, pages, boxed, images).select("pdf", "page", "tier", "box.y_min", "box.y_max", "pixels.x", "pixels.y", "pixels.w", "pixels.h")
