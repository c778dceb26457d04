"""Queries over extraction, synthesis, validation, and dataset forms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weftgraph.functions import text, vocab
from weftgraph.operators import extraction, pages, synthesis, validation
from weftgraph.plans.base import draw_sql, graph_of, query, rules_sql, table, with_graph
from weftgraph.plans.sample_queries import _PACK, SAMPLES, samples
from weftgraph.sources import tables

_BAR = lambda c: F.array_join(c, "|")

# --- replies of a model -------------------------------------------------------------------------------------------
#: (key, reply, triples that can be had from it as subject,relation,object).
REPLIES = (
    (1, '[{"block_id": 1, "triples": [{"subject": "A", "relation": "r", "object": "B"}]}]', "A,r,B"),
    (2, '```json\n[{"block_id": 2, "triples": [{"subject": "C", "relation": "r", "object": "D"}]}]\n```', "C,r,D"),
    (3, '{"block_id": 1, "triples": [{"subject": "E", "relation": "r", "object": "F"}]}', "E,r,F"),
    (4, 'Here it is: [{"block_id": 1, "triples": [{"subject": "G", "relation": "r", "object": "H"}]}] done', "G,r,H"),
    (5, '[{"block_id": 1, "triples": [{"subject": "I", "relation": "r", "object": "J"},]},]', "I,r,J"),
    (6, '[{"block_id": 3, "triples": [{"subject": "K", "relation": "r", "object": "L"}, {"subject": "M", "rel', "K,r,L"),
    (7, '[{"block_id": 1, "triples": []}]', None),
    (8, "no json at all", None),
    (9, "", None),
    (10, '[note] [{"block_id": 1, "triples": [{"subject": "N", "relation": "r", "object": "O"}]}]', "N,r,O"),
    (11, '[{"block_id": 1, "triples": [\n{"subject":\n "P",\n "relation": "r",\n "object": "Q"', "P,r,Q"),
)


def _replies(spark):
    return spark.createDataFrame([(k, r) for k, r, _ in REPLIES], "key int, text string")


@query("SELECT * FROM (VALUES " + ", ".join(f"({k}, '{t}')" for k, _, t in REPLIES if t) + ") v(key, triple)")
def json_recovery(spark, sf):
    r = _replies(spark).withColumn("reply", extraction.recovered(F.col("text"))).select("key", F.lit("u").alias("url"), F.lit(3).alias("n"), "reply")
    return extraction.flattened(r).select("key", F.concat_ws(",", "subject", "relation", "object").alias("triple"))


@query("SELECT doc_id, md5(regexp_replace('{\"a\": [' || n_chars || ', ' || doc_id || ', ], }', ',(\\s*[}\\]])', '\\1', 'g')) AS cleaned FROM documents")
def trailing_comma_clean(spark, sf):
    raw = F.concat(F.lit('{"a": ['), F.col("n_chars").cast("string"), F.lit(", "), F.col("doc_id").cast("string"), F.lit(", ], }"))
    return table(spark, sf, "documents").select("doc_id", F.md5(extraction.without_trailing_commas(raw)).alias("cleaned"))


_CUT = "'[{\"block_id\": ' || (doc_id % 5) || ', \"triples\": [{\"subject\": \"' || lang || '\", \"relation\": \"from\", \"object\": \"' || source || '\"}, {\"subject\": \"x'"


@query(f"SELECT doc_id, '[{{\"block_id\": ' || (doc_id % 5) || ', \"triples\": [' || regexp_extract({_CUT}, '\\{{\"subject\": \"[^\"]*\", \"relation\": \"[^\"]*\", \"object\": \"[^\"]*\"\\}}', 0) || ']}}]' AS repaired FROM documents")
def truncated_repair(spark, sf):
    cut = F.concat(F.lit('[{"block_id": '), (F.col("doc_id") % 5).cast("string"), F.lit(', "triples": [{"subject": "'), "lang", F.lit('", "relation": "from", "object": "'), "source", F.lit('"}, {"subject": "x'))
    return table(spark, sf, "documents").select("doc_id", extraction.complete_triples(cut).alias("repaired"))


@query("SELECT doc_id AS key, source AS source_url, b AS block_id, lang AS subject, 'from' AS relation, source AS object FROM documents, (VALUES (0), (1), (2), (4)) v(b) WHERE b BETWEEN 1 AND 3")
def response_flatten(spark, sf):
    block = lambda b: F.struct(F.lit(b).alias("block_id"), F.array(F.struct(F.col("lang").alias("subject"), F.lit("from").alias("relation"), F.col("source").alias("object"))).alias("triples"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.col("source").alias("url"), F.lit(3).alias("n"), F.array(*map(block, (0, 1, 2, 4))).alias("reply"))
    return extraction.flattened(d)


@query("SELECT doc_id AS key, b AS block_id, lang AS subject FROM documents, (VALUES (0), (1), (4)) v(b)")
def response_flatten_all(spark, sf):
    block = lambda b: F.struct(F.lit(b).alias("block_id"), F.array(F.struct(F.col("lang").alias("subject"), F.lit("from").alias("relation"), F.col("source").alias("object"))).alias("triples"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.col("source").alias("url"), F.lit(3).alias("n"), F.array(*map(block, (0, 1, 4))).alias("reply"))
    return extraction.flattened(d, sizes=False).select("key", "block_id", "subject")


_HEAD = (extraction.INSTRUCTION + ", ".join(vocab.RELATIONS) + "\n" + extraction.EXAMPLE + "\n").replace("'", "''")


@query(f"SELECT conv_id, ((r - 1) // 3)::INT AS chunk, md5('{_HEAD}' || string_agg(((r - 1) % 3 + 1) || '. ' || to_json(text)::VARCHAR, chr(10) ORDER BY r)) AS prompt_md5 FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS r FROM conversations) GROUP BY conv_id, chunk")
def extraction_prompts(spark, sf):
    """A prompt for every chunk of a conversation."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("url"), "turn", "text")
    b = c.withColumn("block_id", F.row_number().over(Window.partitionBy("url").orderBy("turn", "text")))
    return pages.batches(b).select(F.col("url").cast("bigint").alias("conv_id"), "chunk", F.md5(extraction.prompt(F.col("blocks"))).alias("prompt_md5"))


@query()
def model_call(spark, sf):
    """The offline model over every conversation's prompt: no triples, no errors."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("prompt"))
    return extraction.call_model(c).groupBy("reply.ok", "reply.text").agg(F.count("*").alias("n"))


@query("SELECT item_id AS block_id, 0 AS triples FROM benchmark")
def empty_reply_filler(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("block_id"))
    none = spark.createDataFrame([], "block_id bigint, triples array<struct<subject:string,relation:string,object:string>>")
    return extraction.filled(b, none).select("block_id", F.size("triples").alias("triples"))


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


# --- names ---------------------------------------------------------------------------------------------------------
NAMES = ("华为公司", "北京大学", "协和医院", "中国银行", "红楼梦电影", "青花瓷歌曲", "围城小说", "李白", "上海市中心", "二十一世纪初年代", "编号12345678", "甲乙丙丁戊", "甲乙丙丁戊己庚辛", "作家协会成员", "一本厚书籍大全")
_NAMES = "n(name) AS (VALUES " + ", ".join(f"('{n}')" for n in NAMES) + "), x AS (SELECT name FROM n UNION SELECT DISTINCT p_name FROM part)"


def _names(spark, sf):
    return spark.createDataFrame([(n,) for n in NAMES], "name string").union(table(spark, sf, "part").select("p_name")).distinct()


@query(f"WITH {_NAMES} SELECT name, {rules_sql('name', vocab.GENERIC, vocab.GENERIC_ELSE)} AS description FROM x")
def generic_descriptions(spark, sf):
    return _names(spark, sf).select("name", text.generic_description(F.col("name")).alias("description"))


@query(f"WITH {_NAMES} SELECT name, {rules_sql('name', vocab.GENERAL, vocab.GENERAL_ELSE)} AS description FROM x")
def entity_generalisation(spark, sf):
    return _names(spark, sf).select("name", text.general_description(F.col("name")).alias("description"))


_LEAK = "(contains(lower(t), lower(e)) OR (length(e) > 2 AND len(list_filter(range(1, length(e) - 1), lambda i: contains(lower(t), lower(substr(e, i, 3))))) > 0))"


@query(f"SELECT c.conv_id, c.turn, p.p_name AS name, CASE WHEN coalesce(c.text, '') = '' THEN false ELSE {_LEAK.replace('(t)', '(c.text)').replace('(e)', '(p.p_name)').replace('substr(e,', 'substr(p.p_name,')} END AS leak FROM conversations c JOIN part p ON p.p_partkey = c.conv_id")
def leak_check(spark, sf):
    c = table(spark, sf, "conversations").join(table(spark, sf, "part").select(F.col("p_partkey").alias("conv_id"), F.col("p_name").alias("name")), "conv_id")
    return c.select("conv_id", "turn", "name", text.leaks(F.col("text"), F.col("name")).alias("leak"))


# --- numbered replies ------------------------------------------------------------------------------------------------
LINES = ("句子 1: 第一个句子在这里\n句子 2：第二个句子在这里\n", "1. plain first line\n2. plain second line\n3. third", "句子9 没有冒号的一行\n\nnoise", "nothing numbered here", "", "句子 1: [\"quoted text here\"]\n2. 'second quoted'")
_V1 = ("第一个句子在这里|第二个句子在这里", "plain first line|plain second line", "没有冒号的一行|Error: 解析失败", "Error: 解析失败|Error: 解析失败", "Error: 解析失败|Error: 解析失败", "quoted text here|second quoted")
_V0 = ("第一个句子在这里|第二个句子在这里", "plain first line|plain second line", "句子9 没有冒号的一行", "nothing numbered here", "", '["quoted text here"]')


def _lines(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "key int, reply string")


def _expected(values) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({k}, '{v}')" for k, v in enumerate(values)) + ") v(key, parts)"


@query(_expected(_V1))
def numbered_reply_lines(spark, sf):
    return _lines(spark).select("key", _BAR(synthesis.numbered_lines(F.col("reply"), "句子", F.lit(2))).alias("parts"))


@query(_expected(_V0))
def pattern_reply_lines(spark, sf):
    return _lines(spark).select("key", _BAR(synthesis.pattern_lines(F.col("reply"), "句子", F.lit(2))).alias("parts"))


# --- questions -------------------------------------------------------------------------------------------------------
def packages(spark, sf):
    """Clue packages with the facts of their paths."""
    from weftgraph.operators import sampling

    return sampling.clue_packages(sampling.clue_paths(*graph_of(spark, sf)), 40)


_FACTS = "array_to_string(list_transform(triples, lambda f: f.subject || ' ' || f.relation || ' ' || f.object), '。') || '。'"


@query(with_graph(SAMPLES + f" SELECT sample_id, {_FACTS} AS statement FROM smp"))
def clue_statements(spark, sf):
    return samples(spark, sf).select("sample_id", synthesis.fact_statement(F.col("triples")).alias("statement"))


@query(with_graph(SAMPLES + " SELECT sample_id, array_to_string(list_filter(list_transform(triples, lambda f: CASE WHEN f.subject = triples[2].subject THEN f.relation || f.object WHEN f.object = triples[2].subject THEN '被' || f.subject || f.relation END), lambda x: x IS NOT NULL)[1:3], '|') AS context FROM smp"))
def entity_contexts(spark, sf):
    return samples(spark, sf).select("sample_id", _BAR(synthesis.entity_context(F.col("triples")[1]["subject"], F.col("triples"))).alias("context"))


@query(with_graph(f", {_PACK}, e AS (SELECT DISTINCT unnest(clue_entities) AS entity FROM packs), d AS (SELECT entity, {rules_sql('entity', vocab.GENERIC, vocab.GENERIC_ELSE)} AS t FROM e) SELECT entity, CASE WHEN {_LEAK.replace('(e)', '(entity)').replace('substr(e,', 'substr(entity,')} THEN '一个相关实体' ELSE t END AS description FROM d"))
def atomic_obfuscation(spark, sf):
    return synthesis.descriptions(packages(spark, sf))


@query(with_graph(f", {_PACK} SELECT sample_id, len(list_distinct(clue_entities))::INT AS described FROM packs"))
def obfuscation_maps(spark, sf):
    from weftgraph.session import materialise

    p = materialise(packages(spark, sf), "packages")
    return synthesis.obfuscated(p, synthesis.descriptions(p)).select("sample_id", F.size("obfuscated_entities").alias("described"))


@query(with_graph(SAMPLES + f", st_ AS (SELECT sample_id, {_FACTS} AS s, triples[-1].object AS target, [triples[1].subject, triples[-1].object] AS es FROM smp) SELECT sample_id, replace(s, target, '某个相关实体') AS story FROM st_"))
def story_rewrite(spark, sf):
    s = samples(spark, sf)
    return s.select("sample_id", synthesis.story(synthesis.fact_statement(F.col("triples")), F.element_at("triples", -1)["object"]).alias("story"))


@query(with_graph(SAMPLES + f", st_ AS (SELECT sample_id, {_FACTS} AS s, triples[-1].object AS target, list_distinct([triples[1].subject, triples[-1].object]) AS es FROM smp), g AS (SELECT sample_id, list_filter(es, lambda e: contains(s, e) AND NOT contains(replace(s, target, '某个相关实体'), e)) AS gone FROM st_) SELECT sample_id, len(gone)::INT AS generalised FROM g"))
def story_generalisation(spark, sf):
    t, e = F.col("triples"), F.array(F.col("triples")[0]["subject"], F.element_at("triples", -1)["object"])
    s = synthesis.fact_statement(t)
    return samples(spark, sf).select("sample_id", F.size(synthesis.generalised_from_story(s, synthesis.story(s, F.element_at(t, -1)["object"]), e)).alias("generalised"))


_SAID = "['甲', '乙', '丙', '丁']"


@query(with_graph(SAMPLES + f" SELECT sample_id, '根据相关线索，甲通过' || triples[1].relation || '等关系与乙等内容相互关联，这些关系线索共同指向一个特定的目标。' AS integrated, '这里涉及' || array_to_string({_SAID}, '，') || '等相关信息。' AS three_stage FROM smp"))
def narrative_weaving(spark, sf):
    said = F.array(*map(F.lit, "甲乙丙丁"))
    return samples(spark, sf).select("sample_id", synthesis.woven(said, F.col("triples")).alias("integrated"), synthesis.woven(said, strategy="three_stage").alias("three_stage"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN trim(regexp_replace(trim('问题：' || role), '^(问题|问)：', '')) WHEN turn % 3 = 1 THEN '这是什么？' ELSE '这个实体是什么？' END AS question FROM conversations")
def question_fallback(spark, sf):
    reply = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("问题："), "role"))
    return table(spark, sf, "conversations").select("conv_id", "turn", synthesis.plain_question(reply, F.col("turn") % 3 == 1).alias("question"))


def _stem(stems, seed: str, key: str) -> str:
    return "[" + ", ".join(f"'{s}'" for s in stems) + f"][{draw_sql(seed, key)} % {len(stems)} + 1]"


_STRUCT = f"'**问题：**  ' || chr(10) || 'S' || {_stem(vocab.QUESTION_STEMS, 'q', 'sample_id')} || '  ' || chr(10) || chr(10) || '**解析：**  ' || chr(10) || '{vocab.ANALYSIS[0]}' || chr(10) || replace('{vocab.ANALYSIS[1]}', '{{n}}', num_clue_paths::VARCHAR) || chr(10) || '{vocab.ANALYSIS[2]}'"


@query(with_graph(f", {_PACK} SELECT sample_id, {_STRUCT} AS question FROM packs"))
def structured_questions(spark, sf):
    reply = F.concat(F.lit("is it "), "answer_entity")  # leaks, so the structured form is taken
    return packages(spark, sf).select("sample_id", synthesis.safe_question(reply, F.lit("S"), F.col("answer_entity"), F.col("clue_entities"), "q", "sample_id").alias("question"))


@query(with_graph(SAMPLES + " SELECT sample_id, '根据这段描述，你能推断出' || triples[-1].relation || '是什么吗？' AS question FROM smp"))
def legacy_questions(spark, sf):
    return samples(spark, sf).select("sample_id", synthesis.legacy_question(F.element_at("triples", -1)["relation"]).alias("question"))


_PATH = "list_concat([triples[1].subject], list_transform(triples, lambda t: t.object))"
_CQ = f"CASE WHEN len(path) >= 4 THEN '**问题：**  ' || chr(10) || '{vocab.CHAIN_STORY}' || {_stem(vocab.CHAIN_STEMS, 'cq', 'sample_id')} || '  ' || chr(10) || chr(10) || '**解析：**  ' || chr(10) || '1. 根据路径关系，' || path[1] || '通过' || (len(path) - 2) || '步关联。  ' || chr(10) || '2. 关键中间实体包括' || path[2] || '等。  ' || chr(10) || '3. 需要整合路径中的所有关系信息来推理最终答案。' END"


def chain_samples(spark, sf):
    s = samples(spark, sf).withColumn("path", F.concat(F.array(F.col("triples")[0]["subject"]), F.transform("triples", lambda t: t["object"])))
    q = synthesis.chain_question(F.col("path"), "cq", "sample_id")
    s = s.select("sample_id", "triples", "path", q.alias("question"), F.element_at("path", -1).alias("answer"), F.size("path").alias("path_length"))
    said, final = validation.chain_status(F.col("question"), F.col("answer"), F.col("path_length"))
    return s.withColumn("validation_status", said).withColumn("final_status", final).withColumn("strategy", F.lit("chain_of_thought"))


CHAINS = SAMPLES + f", cp AS (SELECT sample_id, triples, {_PATH} AS path FROM smp), cq AS (SELECT *, {_CQ} AS question, path[-1] AS answer FROM cp), cv AS (SELECT *, CASE WHEN question IS NULL OR len(path) < 4 THEN '失败：缺少必要字段' WHEN contains(lower(question), lower(answer)) THEN '失败：问题包含答案' ELSE '通过' END AS validation_status FROM cq), cf AS (SELECT *, CASE WHEN validation_status = '通过' THEN 'validated' ELSE 'failed' END AS final_status FROM cv)"


@query(with_graph(CHAINS + " SELECT sample_id, question, answer FROM cf"))
def chain_questions(spark, sf):
    return chain_samples(spark, sf).select("sample_id", "question", "answer")


@query(with_graph(SAMPLES + ", st_ AS (SELECT sample_id, triples, unnest(range(1, len(triples) + 1)) AS step FROM smp) SELECT sample_id, step::INT AS step, triples[step].subject || ' ' || triples[step].relation || ' ' || triples[step].object AS description FROM st_"))
def reasoning_steps(spark, sf):
    s = samples(spark, sf).select("sample_id", F.explode(synthesis.reasoning_steps(F.col("triples"))).alias("s"))
    return s.select("sample_id", "s.step", "s.description")


@query("SELECT * FROM (VALUES ('chain_of_thought', 20, 0), ('entity_centric', 0, 20), ('combined', 12, 8)) v(strategy, chain, entity)")
def strategy_split(spark, sf):
    rows = [(s, *synthesis.split_counts(20, s, 0.6).values()) for s in ("chain_of_thought", "entity_centric", "combined")]
    return spark.createDataFrame(rows, "strategy string, chain int, entity int")


_B = "coalesce(nullif(trim(CASE WHEN conv_id % 2 = 0 THEN text END), ''), nullif(trim(role), ''), '')"


@query(f"SELECT conv_id, turn, md5(CASE WHEN regexp_matches({_B}, '[。.！!？?]$') THEN {_B} || ' ' || '这是什么？' ELSE {_B} || '。' || '这是什么？' END) AS question_md5 FROM conversations")
def contextual_questions(spark, sf):
    first = F.when(F.col("conv_id") % 2 == 0, F.col("text"))
    q = synthesis.with_background(F.lit("这是什么？"), F.lit("r"), first, F.col("role"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(q).alias("question_md5"))


@query("SELECT sample_id, (i // 10)::BIGINT AS batch_id, (i % 10)::INT AS place FROM (SELECT sample_id, row_number() OVER (ORDER BY substr(md5(sample_id), 1, 3), sample_id) - 1 AS i FROM (SELECT conv_id || '-' || turn AS sample_id FROM conversations))")
def question_batches(spark, sf):
    c = table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("sample_id"))
    return synthesis.batched(c).select("sample_id", "batch_id", "place")


# --- validation ------------------------------------------------------------------------------------------------------
@query(with_graph(CHAINS + " SELECT sample_id, validation_status, final_status FROM cf"))
def chain_validation(spark, sf):
    return chain_samples(spark, sf).select("sample_id", "validation_status", "final_status")


_REPLY = "CASE turn % 4 WHEN 0 THEN '通过' WHEN 1 THEN '不通过' WHEN 2 THEN NULL ELSE '结果：通过' END"


def _verdicts(spark, sf, compat):
    k = F.col("turn") % 4
    reply = F.when(k == 0, "通过").when(k == 1, "不通过").when(k == 3, "结果：通过")
    said, final = validation.verdict(reply, F.col("role") == "user", compat)
    return table(spark, sf, "conversations").select("conv_id", "turn", said.alias("validation_status"), final.alias("final_status"))


def _verdict_sql(passed: str) -> str:
    return f"WITH v AS (SELECT conv_id, turn, role, {_REPLY} AS r FROM conversations), s AS (SELECT conv_id, turn, CASE WHEN role <> 'user' THEN '无效问题' WHEN r IS NULL THEN 'API失败' WHEN {passed} THEN '通过' ELSE '不通过' END AS validation_status FROM v) SELECT *, CASE validation_status WHEN '无效问题' THEN 'invalid' WHEN '通过' THEN 'validated' ELSE 'validation_failed' END AS final_status FROM s"


@query(_verdict_sql("contains(r, '通过') AND NOT contains(r, '不通过')"))
def verdicts(spark, sf):
    return _verdicts(spark, sf, False)


@query(_verdict_sql("contains(r, '通过')"))
def verdicts_compat(spark, sf):
    return _verdicts(spark, sf, True)


@query(f"SELECT conv_id, turn, CASE WHEN coalesce({_REPLY} IN ('通过', '结果：通过'), false) OR NOT contains(lower(text), 'the') THEN 'validated' ELSE 'failed' END AS final_status FROM conversations")
def local_verdicts(spark, sf):
    k = F.col("turn") % 4
    reply = F.when(k == 0, "通过").when(k == 1, "不通过").when(k == 3, "结果：通过")
    return table(spark, sf, "conversations").select("conv_id", "turn", validation.local_verdict(reply, F.col("text"), F.lit("the")).alias("final_status"))


_EXP = f"SELECT sample_id, {_FACTS} AS s, triples[1].object AS answer, triples[-1].object AS path_end FROM smp"


@query(with_graph(SAMPLES + f", x AS ({_EXP}) SELECT round(avg(CASE WHEN NOT contains(lower(s), lower(answer)) THEN 1.0 ELSE 0.0 END), 6) AS valid, round(avg(CASE WHEN NOT contains(lower(s), lower(answer)) THEN 1.0 ELSE 0.0 END), 6) AS clue_purity, round(avg(CASE WHEN answer <> path_end THEN 1.0 ELSE 0.0 END), 6) AS target_diversity FROM x"))
def sample_quality(spark, sf):
    t = F.col("triples")
    s = samples(spark, sf).select(synthesis.fact_statement(t).alias("integrated_clue_statement"), F.lit("q").alias("final_question"), t[0]["object"].alias("answer"), t[0]["object"].alias("target_entity"), F.element_at(t, -1)["object"].alias("path_end"))
    return validation.sample_quality(s)


def _path_rows(spark, sf):
    from weftgraph.session import materialise

    s = materialise(samples(spark, sf), "samples").select("sample_id", F.posexplode("triples").alias("hop", "t"))
    return s.select("sample_id", "hop", "t.subject", "t.relation", "t.object")


_COMPLEX = "ends AS (SELECT sample_id, unnest(list_concat(list_transform(triples, lambda t: t.subject), list_transform(triples, lambda t: t.object))) AS name FROM smp), cx AS (SELECT sample_id, count(DISTINCT type) - 1 AS jumps FROM ends JOIN nodes USING (name) GROUP BY sample_id)"


@query(with_graph(SAMPLES + f", {_COMPLEX} SELECT sample_id, len(triples) AS path_length, jumps::BIGINT AS domain_jumps, (len(triples) * (1 + jumps) * 2.5)::DOUBLE AS overall FROM smp JOIN cx USING (sample_id)"))
def complexity_scores(spark, sf):
    return validation.complexity(_path_rows(spark, sf), graph_of(spark, sf)[0], "sample_id")


_EV = "ev0 AS (SELECT sample_id, unnest(triples) AS t, unnest(range(len(triples))) AS hop FROM smp), ev1 AS (SELECT sample_id, source_url, min(hop) AS hop FROM ev0 JOIN edges ON src = t.subject AND dst = t.object AND relation = t.relation GROUP BY ALL), ev AS (SELECT sample_id, string_agg(source_url, '|' ORDER BY hop) AS supporting_evidence FROM ev1 GROUP BY sample_id)"


@query(with_graph(SAMPLES + f", {_COMPLEX}, {_EV}, f AS (SELECT *, row_number() OVER (ORDER BY sample_id) - 1 AS i FROM smp JOIN cx USING (sample_id) JOIN ev USING (sample_id)) SELECT 'mq_id_' || lpad(i::VARCHAR, 5, '0') AS id, triples[-1].object AS answer, (len(triples) * (1 + jumps) * 2.5)::DOUBLE AS overall, supporting_evidence FROM f"))
def final_records(spark, sf):
    n, e = graph_of(spark, sf)
    p = _path_rows(spark, sf)
    last = p.groupBy("sample_id").agg(F.max_by("object", "hop").alias("answer")).select("sample_id", "answer", F.lit("q").alias("question"), F.lit("Chain Reasoning").alias("architecture"))
    r = validation.final_records(last, validation.complexity(p, n, "sample_id"), validation.evidence(p, e, "sample_id"), "sample_id")
    return r.select("id", "answer", F.col("complexity_scores.overall").alias("overall"), _BAR("supporting_evidence").alias("supporting_evidence"))


def qa_samples(spark, sf):
    """Packages with stories, questions and statuses of the fixed branches."""
    p = packages(spark, sf)
    p = p.withColumn("narrative_story", F.concat(F.lit("story of "), F.size("clue_entities").cast("string"))).withColumn("generated_question", synthesis.structured_question(F.col("narrative_story"), F.col("clue_entities"), "q", "sample_id"))
    said, final = validation.verdict(F.when(F.substr(F.md5("sample_id"), F.lit(1), F.lit(1)) < "8", "通过").otherwise("不通过"), F.lit(True))
    return p.withColumn("validation_status", said).withColumn("final_status", final)


_QA = f"{_PACK}, qa AS (SELECT *, 'story of ' || num_clue_paths AS story, {_STRUCT.replace(chr(39) + 'S' + chr(39), chr(39) + 'story of ' + chr(39) + ' || num_clue_paths')} AS question, CASE WHEN md5(sample_id)[1] < '8' THEN 'validated' ELSE 'validation_failed' END AS final_status FROM packs)"


@query(with_graph(f", {_QA} SELECT sample_id AS id, question, answer_entity AS answer, length(question) AS question_length, num_clue_paths AS clue_count FROM qa WHERE final_status = 'validated'"))
def validated_dataset(spark, sf):
    return validation.validated(qa_samples(spark, sf)).select("id", "question", "answer", F.col("generation_metadata.question_length").alias("question_length"), F.col("generation_metadata.clue_count").alias("clue_count"))


@query(with_graph(f", {_QA} SELECT question, answer_entity AS answer FROM qa WHERE final_status = 'validated'"))
def simple_dataset(spark, sf):
    return validation.simple(validation.validated(qa_samples(spark, sf)))


@query(with_graph(f", {_QA} SELECT sample_id, answer_entity, final_status FROM qa"))
def detailed_dataset(spark, sf):
    return validation.detailed(qa_samples(spark, sf)).select("sample_id", "answer_entity", "final_status")


@query(with_graph(f", {_QA} SELECT count(*) AS total_samples, count(*) FILTER (final_status = 'validated') AS validated_count, round(avg(CASE WHEN final_status = 'validated' THEN 100.0 ELSE 0 END), 6) AS validation_rate, round(avg(length(question)) FILTER (final_status = 'validated'), 6) AS avg_question_len, round(avg(length(story)) FILTER (final_status = 'validated'), 6) AS avg_story_len, round(avg(num_clue_paths) FILTER (final_status = 'validated'), 6) AS avg_clue_count FROM qa"))
def dataset_summary(spark, sf):
    return validation.summary(qa_samples(spark, sf))


@query(with_graph(f", {_QA} SELECT final_status, count(*) AS n FROM qa GROUP BY 1"))
def status_distribution(spark, sf):
    return validation.status_distribution(qa_samples(spark, sf))


@query(with_graph(CHAINS + " SELECT count(*) AS total_samples, count(*) AS chain_samples, 0::BIGINT AS entity_samples, count(*) FILTER (final_status = 'validated') AS validated_count, round(avg(CASE WHEN final_status = 'validated' THEN 100.0 ELSE 0 END), 6) AS validation_rate, count(*) FILTER (final_status = 'validated') AS simple_count FROM cf"))
def integrated_summary(spark, sf):
    return validation.strategy_summary(chain_samples(spark, sf))


@query("SELECT round(avg(CASE WHEN text <> '' THEN 100.0 ELSE 0 END), 6) AS context_percentage, round(avg(length(text)), 6) AS avg_length, round(avg(CASE WHEN role <> '' THEN 100.0 ELSE 0 END), 6) AS answer_percentage, round(avg(turn), 6) AS avg_clue_count FROM conversations")
def contextual_metrics(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("text").alias("background"), F.col("text").alias("question"), F.col("role").alias("answer"), F.col("turn").alias("clue_count"))
    return validation.contextual_metrics(c)


@query("SELECT source, CASE WHEN avg(quality) * 100 < 60 THEN 'low' WHEN avg(quality) * 100 > 80 THEN 'high' ELSE 'medium' END AS grade FROM documents JOIN labels USING (doc_id) GROUP BY source")
def run_grades(spark, sf):
    r = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").groupBy("source").agg((F.avg("quality") * 100).alias("rate"))
    return r.select("source", validation.run_grade(F.col("rate")).alias("grade"))


@query("SELECT 'traditional_' || (row_number() OVER (ORDER BY conv_id * 1000 + turn) - 1) AS id, 'Q' || turn AS question, role AS answer FROM conversations WHERE turn % 2 = 0")
def traditional_format(spark, sf):
    line = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct(F.concat(F.lit("Q"), F.col("turn").cast("string")).alias("question"), F.col("role").alias("answer")))).otherwise("broken {")
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("pos"), line.alias("value"))
    return tables.traditional(c).select("id", "question", "answer")


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'stage1' ELSE 'stage2' END AS stage FROM conversations")
def stage_snapshots(spark, sf):
    """All turns, dealt between two stages and read back stage by stage."""
    from weftgraph.plans.graph_queries import folder

    path = folder(spark, "stages")
    c = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("conv_id") % 4).cast("string").alias("batch_id"))
    tables.save_stage(c.where("turn % 2 = 0"), path, "stage1")
    tables.save_stage(c.where("turn % 2 = 1 OR turn IS NULL"), path, "stage2")
    one, two = (spark.read.parquet(path).where(F.col("stage") == s).select("conv_id", "turn", "stage") for s in ("stage1", "stage2"))
    return one.unionByName(two)


SSE = 'data: {"choices":[{"delta":{"content":"ab"}}]}\n\ndata: broken\ndata: {"choices":[{"message":{"content":"cd"}}]}\ndata: [DONE]\ndata: {"choices":[{"delta":{"content":"zz"}}]}'


@query("SELECT 'abcd' AS text")
def event_stream_assembly(spark, sf):
    return spark.createDataFrame([(extraction.assemble_events(SSE),)], "text string")
