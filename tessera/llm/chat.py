"""Chat formatting: links tool calls with their results, orders them, checks arguments, writes canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep, pick
from tessera.session import sized

#: Kinds of JSON values by the type that a schema names.
KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",)}
#: Tools of the query: name, parameter, type, required. Turns break them: see tool_tables.
TOOLS = [
    ("ask", "text", "string", True),
    ("ask", "turn", "integer", True),
    ("ask", "title", "string", True),
    ("ask", "lines", "integer", False),
    ("ask", "words", "integer", False),
    ("configure", "text", "string", True),
]
ROLES = ("user", "system", "assistant")


def depths(calls: DataFrame) -> DataFrame:
    """call_id, depth: the number of calls before each along `after`; null for calls in or behind a circle.

    A call names at most one call that it follows, so paths are chains, and each round doubles the
    stretch that is known; a call that names one that does not exist is first. A circle never ends, and
    is known as such once the stretch is longer than there are calls.
    """
    ids = calls.select("call_id")
    known = calls.join(ids.withColumnRenamed("call_id", "after"), "after", "left_semi")
    now = keep(calls.join(known.select("call_id", F.col("after").alias("up")), "call_id", "left").select("call_id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth")), "depths")
    reach, n = 1, None
    while True:
        open_ = now.where("up IS NOT NULL").count()
        n = open_ if n is None else n
        if not open_ or reach > n:
            break
        above = now.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        now = keep(now.join(above, "up", "left").select("call_id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "depths")
        reach *= 2
    return now.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _kind(value: Column) -> Column:
    """STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, OBJECT, ARRAY or VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def errors(arguments: Column, parameters: Column) -> Column:
    """What is wrong with parsed arguments: missing, unknown and mistyped parameters, by name; null parameters: no such tool."""
    fields = F.from_json(arguments, "map<string,variant>")
    names = F.map_keys(fields)
    missing = F.transform(F.filter(parameters, lambda p: p["required"] & ~F.array_contains(names, p["parameter"])), lambda p: F.concat(F.lit("missing "), p["parameter"]))
    known = F.transform(parameters, lambda p: p["parameter"])
    unknown = F.transform(F.filter(names, lambda name: ~F.array_contains(known, name)), lambda name: F.concat(F.lit("unknown "), name))
    allowed = F.create_map(*[x for name, kinds in KINDS.items() for x in (F.lit(name), F.array(*map(F.lit, kinds)))])
    wrong = F.transform(
        F.filter(
            parameters,
            lambda p: F.array_contains(names, p["parameter"]) & ~F.coalesce(F.array_contains(F.get(F.transform(F.array(p["type"]), lambda t: allowed[t]), F.lit(0)), _kind(fields[p["parameter"]])), F.lit(False)),
        ),
        lambda p: F.concat(F.lit("type "), p["parameter"]),
    )
    found = F.array_sort(F.concat(missing, unknown, wrong))
    return F.when(fields.isNull(), F.array(F.lit("not an object"))).when(parameters.isNull(), F.array(F.lit("no such tool"))).otherwise(found)


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per identifier: call_id, name, after, depth, status, valid, errors, json, n_calls, n_results.

    calls: call_id, name, arguments (JSON text), after (the call it follows, or null). results:
    call_id, content. schemas: name, parameter, type, required. Calls and results meet by identifier
    (status linked, no_result or no_call). An identifier that occurs more often is one row with the counts
    n_calls and n_results; the least (name, arguments, after) and the least content stand for it, merged
    before the join, so that a frequent one is no product. depth is the place in the order of `after`;
    it is null in circles. Arguments must be a JSON object with the tool's required parameters, of their
    types, and no others. json has sorted keys, no white space, and null for what is missing. Rows
    without an identifier are the identifier null: never linked, one row for calls and one for results.
    Empty tables give no rows; other columns are ignored.
    """
    calls = pick(calls, "call_id", "name", "arguments", "after")
    one = calls.groupBy("call_id").agg(F.min(F.struct("name", "arguments", "after")).alias("c"), F.count("*").alias("n_calls"))
    one = keep(one.select("call_id", "c.*", "n_calls"), "calls")
    answers = pick(results, "call_id", "content").groupBy("call_id").agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    linked = one.join(answers, "call_id", "full").join(depths(one.where("call_id IS NOT NULL").select("call_id", "after")), "call_id", "left")
    tools = pick(schemas, "name", "parameter", "type", "required").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("parameter", "type", "required"))).alias("parameters"))
    linked = linked.join(sized(tools), "name", "left")
    linked = linked.withColumn("n_calls", F.coalesce("n_calls", F.lit(0))).withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    status = F.when(F.col("n_calls") == 0, "no_call").when(F.col("n_results") == 0, "no_result").otherwise("linked")
    linked = linked.withColumn("errors", F.when(F.col("n_calls") > 0, errors(F.col("arguments"), F.col("parameters"))))
    written = F.to_json(
        F.struct(F.try_parse_json("arguments").alias("arguments"), "call_id", "depth", "name", F.col("content").alias("result")),
        {"ignoreNullFields": "false"},
    )
    return linked.select("call_id", "name", "after", "depth", status.alias("status"), (F.size("errors") == 0).alias("valid"), "errors", written.alias("json"), "n_calls", "n_results")


def _call_id(prefix: str, back: int = 0) -> Column:
    turn = F.col("turn") - back
    return F.concat_ws("_", F.lit(prefix), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.coalesce(turn.cast("string"), F.lit("null")))


def tool_tables(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and rows of other roles read from turns: a user's turn asks, a system's configures, the assistant's next turn is the result.

    A user's call has the text, the turn, the number of words, the number of lines (one line is the text "1", no
    integer), a title (the text before its first full stop, where more follows it) and a question mark's flag
    where the text has one, so whether its arguments fit the schema depends on the turn. A call follows the
    user's turn two before it, if there is one. Identifiers are conversation and turn.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    asks = F.col("role") == "user"
    stop = F.instr("text", ".")
    lines = F.size(F.split("text", "\n"))

    def given(count: Column) -> Column:
        return F.to_json(
            F.struct(
                F.when(F.col("text").isNotNull(), count).alias("lines"),
                F.when(F.contains("text", F.lit("?")), F.lit(True)).alias("question"),
                "text",
                F.when((stop > 0) & (stop < F.char_length("text")), F.substring("text", F.lit(1), stop - 1)).alias("title"),
                "turn",
                F.size(F.split(F.trim(F.col("text")), r"\s+")).alias("words"),
            )
        )

    asked = F.when(lines > 1, given(lines)).otherwise(given(F.lit("1")))
    calls = rows.where(F.col("role").isin("user", "system")).select(
        _call_id("call").alias("call_id"),
        F.when(asks, "ask").otherwise("configure").alias("name"),
        F.when(asks, asked).otherwise(F.to_json(F.struct("text"))).alias("arguments"),
        F.when(asks & F.col("turn").isNotNull(), _call_id("call", 2)).alias("after"),
    )
    results = rows.where(F.col("role") == "assistant").select(_call_id("call", 1).alias("call_id"), F.col("text").alias("content"))
    others = rows.where(~F.coalesce(F.col("role").isin(*ROLES), F.lit(False))).select(_call_id("turn").alias("call_id"))
    return calls, results, others


def op6_tool_calls(spark, sf_dir):
    """Calls with their results, and with the status other_role a row for each turn of any other role or none."""
    calls, results, others = tool_tables(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    schemas = spark.createDataFrame(TOOLS, "name string, parameter string, type string, required boolean")
    found = link_calls(calls, results, schemas)
    found = found.withColumn("errors", F.array_join("errors", ","))
    kinds = {f.name: f.dataType for f in found.schema}
    fixed = {"call_id": F.col("call_id"), "status": F.lit("other_role"), "n_calls": F.lit(0), "n_results": F.lit(0)}
    return found.union(others.select(*[fixed.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in found.columns]))


OP6_SQL = r"""
WITH RECURSIVE t AS (
    SELECT 'call_' || coalesce(conv_id::VARCHAR, 'null') || '_' AS pre, conv_id, turn, role, text, len(string_split(text, chr(10))) AS lines,
        CASE WHEN instr(text, '.') > 0 AND instr(text, '.') < length(text) THEN left(text, instr(text, '.') - 1) END AS title FROM conversations
), c0 AS (
    SELECT pre || coalesce(turn::VARCHAR, 'null') AS call_id, CASE WHEN role = 'user' THEN 'ask' ELSE 'configure' END AS name,
        CASE WHEN role = 'user' AND turn IS NOT NULL THEN pre || (turn - 2)::VARCHAR END AS after,
        '{' || concat_ws(',',
            CASE WHEN role = 'user' AND text IS NOT NULL THEN '"lines":' || CASE WHEN lines > 1 THEN lines::VARCHAR ELSE '"1"' END END,
            CASE WHEN role = 'user' AND contains(text, '?') THEN '"question":true' END,
            '"text":' || to_json(text)::VARCHAR,
            CASE WHEN role = 'user' THEN '"title":' || to_json(title)::VARCHAR END,
            CASE WHEN role = 'user' THEN '"turn":' || turn END,
            CASE WHEN role = 'user' THEN '"words":' || len(regexp_split_to_array(trim(text, ' '), '\s+')) END) || '}' AS arguments,
        concat_ws(',', CASE WHEN text IS NULL THEN 'missing text' END, CASE WHEN role = 'user' AND title IS NULL THEN 'missing title' END,
            CASE WHEN role = 'user' AND turn IS NULL THEN 'missing turn' END, CASE WHEN role = 'user' AND lines = 1 THEN 'type lines' END,
            CASE WHEN role = 'user' AND contains(text, '?') THEN 'unknown question' END) AS errors
    FROM t WHERE role IN ('user', 'system')
), c AS (
    SELECT call_id, min(name) AS name, min(arguments) AS arguments, min(errors) AS errors, min(after) AS after, count(*) AS n_calls FROM c0 GROUP BY call_id
), r AS (
    SELECT pre || (turn - 1)::VARCHAR AS call_id, min(text) AS content, count(*) AS n_results FROM t WHERE role = 'assistant' GROUP BY 1
), d(call_id, depth) AS (
    SELECT call_id, 0::BIGINT FROM c WHERE after IS NULL OR after NOT IN (SELECT call_id FROM c)
    UNION ALL SELECT c.call_id, d.depth + 1 FROM c JOIN d ON c.after = d.call_id
)
SELECT coalesce(c.call_id, r.call_id) AS call_id, name, after, d.depth,
    CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    errors = '' AS valid, errors,
    '{"arguments":' || coalesce(arguments, 'null') || ',"call_id":' || to_json(coalesce(c.call_id, r.call_id))::VARCHAR || ',"depth":' || coalesce(d.depth::VARCHAR, 'null')
        || ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json,
    coalesce(n_calls, 0)::BIGINT AS n_calls, coalesce(n_results, 0)::BIGINT AS n_results
FROM c FULL JOIN r ON c.call_id = r.call_id LEFT JOIN d ON d.call_id = c.call_id
UNION ALL
SELECT 'turn_' || coalesce(conv_id::VARCHAR, 'null') || '_' || coalesce(turn::VARCHAR, 'null'), NULL, NULL, NULL, 'other_role', NULL, NULL, NULL, 0, 0
FROM t WHERE role IS NULL OR role NOT IN ('user', 'system', 'assistant')
"""
