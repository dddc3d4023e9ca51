"""Tool-call linking: calls and results joined by identifier, ordered by what they depend on, checked and serialised.

A call's arguments may name other calls of its conversation (a string value `$<call_id>`); such a call comes after
those. Chains of calls with one dependency each are folded by doubling, in as many rounds as the logarithm of their
length; what is left, calls with several dependencies, is peeled: a round takes all calls whose dependencies have levels,
and touches only the edges of what the round before took. Everything is a DataFrame expression, and no conversation is
ever gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: Fixed tool schemas of the production query: argument, its JSON type (or the schema of an object), whether it must be
#: there.
SCHEMAS = {
    "configure": {"text": ("string", True)},
    "write": {"text": ("string", True), "layout": ({"title": ("string", True), "lines": ("integer", True), "width": ("integer", False)}, True), "after": ("array", False)},
    "say": {"text": ("string", True), "layout": ({"width": ("integer", True)}, False), "after": ("array", False)},
}
#: Fixed names: what variants of a JSON type are called.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "^BOOLEAN$", "array": "^ARRAY.*$", "object": "^OBJECT.*$"}
REFERENCE = r'"\$([^"\\]+)"'


def canonical(json: Column) -> Column:
    """JSON without white space, keys sorted at every depth; null if it can't be parsed or repeats a key."""
    return F.to_json(F.try_parse_json(json))


def _wrong(value: Column, wanted: dict, path: str = "") -> list[Column]:
    """Arrays of what is wrong with an object (a variant), one for each key and schema."""
    there = F.variant_get(value, "$", "variant")
    keys = F.json_object_keys(F.to_json(there))
    own = [F.transform(F.array_except(keys, F.array(*map(F.lit, wanted))), lambda k: F.concat(F.lit(f"unexpected {path}"), k))]
    for key, (kind, needed) in wanted.items():
        has, its = F.array_contains(keys, key), F.try_variant_get(value, f"$.{key}", "variant")
        named = "object" if isinstance(kind, dict) else kind
        fits = F.coalesce(F.schema_of_variant(its).rlike(TYPES[named]), F.lit(False))
        wrong = F.when(has & ~fits, F.lit(f"{path}{key} is not {named}"))
        own.append(F.array_compact(F.array(F.when(~has, F.lit(f"missing {path}{key}")).otherwise(wrong) if needed else wrong)))
        if isinstance(kind, dict):
            inner = F.concat(*_wrong(its, kind, f"{path}{key}."))
            own.append(F.when(has & fits, inner).otherwise(F.array().cast("array<string>")))
    return own


def errors(name: Column, arguments: Column, schemas: dict = SCHEMAS) -> Column:
    """What is wrong with a call's arguments, sorted, of objects at any depth: a bounded expression for each tool of the
    schemas (a parameter)."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).rlike(TYPES["object"]), F.lit(False))
    found = F.array(F.lit("unknown tool"))
    for tool, wanted in schemas.items():
        checked = F.when(~is_object, F.array(F.lit("not an object"))).otherwise(F.array_sort(F.concat(*_wrong(value, wanted))))
        found = F.when(name == tool, checked).otherwise(found)
    return found


def _folded(single: DataFrame) -> DataFrame:
    """conv_id, call_id, root, far of single (conv_id, call_id, needs), calls with one dependency: the first call without
    exactly one along the way, and how far it is. Calls on or behind a circle of such calls get no row."""
    key = ["conv_id", "call_id"]
    ends = single.select("conv_id", F.col("needs").alias("root")).join(single.select("conv_id", F.col("call_id").alias("root")), ["conv_id", "root"], "left_anti").distinct()
    ahead = single.select(*key, F.col("needs").alias("root"), F.lit(1).alias("far")).join(ends.withColumn("done", F.lit(True)), ["conv_id", "root"], "left")
    ahead = cut(ahead.select(*key, "root", "far", F.coalesce("done", F.lit(False)).alias("done")), "folded")
    found = ahead.where("done")
    while True:
        rest = ahead.where("NOT done")
        via = ahead.select("conv_id", F.col("call_id").alias("root"), F.col("root").alias("_root"), F.col("far").alias("_far"), F.col("done").alias("_done"))
        rest = rest.join(via, ["conv_id", "root"]).select(*key, F.col("_root").alias("root"), (F.col("far") + F.col("_far")).alias("far"), F.col("_done").alias("done"))
        new = cut(rest, "folded")
        if new.where("done").isEmpty():  # a chain twice as long would have shorter ones: the rest are circles
            return found.drop("done")
        found = found.unionByName(new.where("done"))
        ahead = cut(found.unionByName(new.where("NOT done")), "folded")
        found = ahead.where("done")


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, call_id, level for calls (conv_id, call_id): 0 without dependencies, else one more than the greatest of
    theirs. Edges (conv_id, call_id, needs) are distinct and lie within calls. Calls on a circle, or behind one, get no
    row. Rounds: the logarithm of the longest chain of single dependencies, and one for each step between calls with
    several; each of the latter reads the edges of the calls that the round before took."""
    key = ["conv_id", "call_id"]
    if edges.isEmpty():
        return calls.select(*key, F.lit(0).alias("level"))
    counts = cut(edges.groupBy(*key).agg(F.count("*").alias("open"), F.min("needs").alias("needs")), "needs")
    free = calls.join(counts, key, "left_anti").select(*key)
    folded = cut(_folded(counts.where("open = 1").select(*key, "needs")), "folded")
    behind = folded.select("conv_id", F.col("call_id").alias("needs"), "root", "far")
    several = counts.where("open > 1").select(*key, "open")
    took = cut(free.select(*key, F.lit(0).alias("level")), "took")
    found = took
    if not several.isEmpty():
        # a dependency with one of its own stands for the root of its chain; those in or behind circles keep their own name
        left = cut(several, "open")
        graph = edges.join(several.select(*key), key, "left_semi").join(behind, ["conv_id", "needs"], "left")
        graph = cut(graph.select(*key, F.coalesce("root", "needs").alias("root"), (F.coalesce("far", F.lit(0)) + 1).alias("far")), "graph")
        best = left.select(*key, F.lit(0).alias("level")).limit(0)
        while not left.isEmpty() and not took.isEmpty():
            met = graph.join(took.select("conv_id", F.col("call_id").alias("root"), "level"), ["conv_id", "root"])
            met = met.groupBy(*key).agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("far")).alias("level"))
            best = cut(best.unionByName(met.select(*key, "level")).groupBy(*key).agg(F.max("level").alias("level")), "best")
            left = cut(left.join(met.select(*key, "met"), key, "left").select(*key, (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")), "open")
            took = cut(left.where("open = 0").select(*key).join(best, key), "took")
            left = left.where("open > 0")
            found = found.unionByName(took)
    found = cut(found, "levels")
    chained = folded.join(found.withColumnRenamed("call_id", "root"), ["conv_id", "root"]).select(*key, (F.col("level") + F.col("far")).alias("level"))
    return found.unionByName(chained)


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """conv_id, call_id, turn, level, status, errors, json: a row for each call, and one for each result without a call.

    calls: conv_id, call_id, turn, name, arguments (JSON text); results: conv_id, call_id, turn, content. Calls and
    results are joined by (conv_id, call_id); of several with the same identifier the earliest turn counts (then the
    least text), the others are left out of the linking and come back as `duplicate call`; later results are dropped
    but counted in the first's `results`. Rows whose conv_id or call_id is null are `no identifier`. Order: level,
    turn, call_id. status is the first that holds of: no identifier, duplicate call, no call (an orphan result), circle
    (no level), missing dependency (a reference to no call), invalid arguments, no result, linked. json is canonical
    and is there for calls whose arguments parse. Other columns are dropped. No rows give no rows.
    """
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments")
    results = results.select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content")
    named = (F.col("conv_id").isNotNull()) & (F.col("call_id").isNotNull())
    # one row for each identifier, counted before the shuffle; the rest are told apart by not being it
    first = calls.where(named).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments")).alias("c"), F.count("*").alias("calls"))
    first = cut(first.select("conv_id", "call_id", "c.turn", "c.name", "c.arguments", "calls"), "calls")
    given = results.where(named).groupBy("conv_id", "call_id").agg(F.min(F.struct("result_turn", "content")).alias("r"), F.count("*").alias("results"))
    given = given.select("conv_id", "call_id", "r.result_turn", "r.content", "results")

    refs = first.select("conv_id", "call_id", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), 1))).alias("needs"))
    refs = cut(refs, "references")
    ids = first.select("conv_id", F.col("call_id").alias("needs"))
    edges = cut(refs.join(ids, ["conv_id", "needs"], "left_semi"), "edges")
    astray = refs.join(ids, ["conv_id", "needs"], "left_anti").select("conv_id", "call_id").distinct().withColumn("astray", F.lit(True))
    order = levels(first.select("conv_id", "call_id"), edges)

    key = ["conv_id", "call_id"]
    rows = first.join(given, key, "full").join(order, key, "left").join(astray, key, "left")
    rows = rows.withColumn("errors", F.when(F.col("calls").isNotNull(), errors(F.col("name"), F.col("arguments"), schemas)))
    status = (
        F.when(F.col("calls").isNull(), "no call").when(F.col("level").isNull(), "circle").when(F.col("astray"), "missing dependency")
        .when(F.size("errors") > 0, "invalid arguments").when(F.col("results").isNull(), "no result").otherwise("linked")
    )
    whole = F.to_json(F.struct("call_id", "name", "content", "turn", "result_turn", "level"))
    # canonical arguments are put in as they are; the variant sorts all keys of the rest
    text = F.concat(F.lit('{"arguments":'), canonical(F.col("arguments")), F.lit(","), F.substring(canonical(whole), 2, 1 << 30))
    done = rows.select(*key, F.coalesce("turn", "result_turn").alias("turn"), "level", status.alias("status"), F.array_join("errors", "; ").alias("errors"), F.when(F.col("calls").isNotNull(), text).alias("json"))
    again = first.where("calls > 1").select(*key, F.struct("turn", "name", "arguments").alias("c"), F.col("calls"))
    return done.unionByName(_others(calls, again)).unionByName(_unnamed(calls, results, named))


def _others(calls: DataFrame, again: DataFrame) -> DataFrame:
    """The calls behind the first of their identifier: all rows but one of those equal to it."""
    key = ["conv_id", "call_id"]
    same = calls.join(again, key).groupBy(*key, "turn", "name", "arguments").agg(F.count("*").alias("n"), F.first((F.col("c.turn").eqNullSafe(F.col("turn"))) & (F.col("c.name").eqNullSafe(F.col("name"))) & (F.col("c.arguments").eqNullSafe(F.col("arguments")))).alias("is_first"))
    same = same.withColumn("n", F.col("n") - F.when(F.col("is_first"), 1).otherwise(0)).where("n > 0")
    # as many rows as were counted, by way of arrays of a bounded length
    many = same.select(*key, "turn", "n", F.explode(F.expr("sequence(0, (n - 1) div 4096)")).alias("_k"))
    rows = many.select(*key, "turn", F.explode(F.expr("sequence(1, least(n - _k * 4096, 4096))")).alias("_"))
    return rows.select(*key, "turn", F.lit(None).cast("int").alias("level"), F.lit("duplicate call").alias("status"), F.lit(None).cast("string").alias("errors"), F.lit(None).cast("string").alias("json"))


def _unnamed(calls: DataFrame, results: DataFrame, named: Column) -> DataFrame:
    rows = calls.where(~named).select("conv_id", "call_id", "turn").unionByName(results.where(~named).select("conv_id", "call_id", F.col("result_turn").alias("turn")))
    return rows.select("conv_id", "call_id", "turn", F.lit(None).cast("int").alias("level"), F.lit("no identifier").alias("status"), F.lit(None).cast("string").alias("errors"), F.lit(None).cast("string").alias("json"))


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read off plain conversations (conv_id, turn, role, text), of whole texts and all roles: each
    assistant or system turn is a call, each user turn a result of the turn before it (an opening one of no call). A system turn
    configures; an assistant turn of several lines writes, with a layout, one of a single line says. A call names the one
    two turns before it, of some lengths of text also the one before that, or the one behind it, which makes circles; the
    width is a number of characters a line, whole or not."""
    n, text = F.length("text"), F.coalesce("text", F.lit(""))
    lines = F.size(F.split(text, "\n"))
    name = F.when(F.col("role") == "system", "configure").when(lines > 1, "write").otherwise("say")
    call = lambda step: F.concat(F.lit("$"), F.concat_ws("-", "conv_id", (F.col("turn") + step).cast("string")))
    width = F.when(n % lines == 0, F.to_json(F.struct((n / lines).cast("long").alias("w")))).otherwise(F.to_json(F.struct(F.round(n / lines, 1).cast("decimal(12,1)").alias("w"))))
    width = F.when(n % 29 == 0, F.lit('"wide"')).otherwise(F.regexp_extract(width, ":(.*)}$", 1))
    title = F.split_part(text, F.lit("\n"), F.lit(1))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    inner = F.concat_ws(", ", F.when((lines > 1) & (F.length(title) <= 80), F.concat(F.lit('"title": '), quoted(title))), F.when(lines > 1, F.concat(F.lit('"lines":'), lines.cast("string"))), F.concat(F.lit('"width" : '), width))
    needs = F.array_compact(F.array(F.when(n % 13 == 0, call(2)).when(F.col("turn") >= 3, call(-2)), F.when((n % 5 == 0) & (F.col("turn") >= 5), call(-4))))
    after = F.when(F.size(needs) > 0, F.concat(F.lit('"after":["'), F.array_join(needs, '", "'), F.lit('"]')))
    whole = F.concat(F.lit("{ "), F.concat_ws(", ", F.concat(F.lit('"text":'), quoted(text)), F.when(F.col("role") != "system", F.concat(F.lit('"layout":{'), inner, F.lit("}"))), after), F.lit(" }"))
    arguments = F.when(n % 23 == 0, F.concat(F.lit("["), quoted(text))).otherwise(whole)
    calls = conversations.where("role IN ('assistant', 'system')").select("conv_id", F.concat_ws("-", "conv_id", "turn").alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"))
    results = conversations.where("role = 'user'").select("conv_id", F.concat_ws("-", F.col("conv_id"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def link_conversations(conversations: DataFrame) -> DataFrame:
    return link(*from_conversations(conversations))


#: DuckDB builds the same calls, and judges them by parsing their JSON.
ORACLE_SQL = """
WITH RECURSIVE c0 AS (SELECT conv_id, conv_id || '-' || turn AS call_id, turn, role, coalesce(text, '') AS text, length(text) AS n, len(string_split(coalesce(text, ''), chr(10))) AS lines FROM conversations WHERE role IN ('assistant', 'system')),
c1 AS (SELECT *, CASE WHEN role = 'system' THEN 'configure' WHEN lines > 1 THEN 'write' ELSE 'say' END AS name,
  CASE WHEN n % 29 = 0 THEN '"wide"' WHEN n % lines = 0 THEN CAST(n // lines AS VARCHAR) ELSE CAST(CAST(round(n / lines, 1) AS DECIMAL(12,1)) AS VARCHAR) END AS width,
  list_filter([CASE WHEN n % 13 = 0 THEN conv_id || '-' || (turn + 2) WHEN turn >= 3 THEN conv_id || '-' || (turn - 2) END, CASE WHEN n % 5 = 0 AND turn >= 5 THEN conv_id || '-' || (turn - 4) END], lambda x: x IS NOT NULL) AS needs FROM c0),
c AS MATERIALIZED (SELECT conv_id, call_id, turn, name, needs, n % 23 = 0 AS broken, CASE WHEN n % 23 = 0 THEN NULL ELSE '{"text":' || to_json(text) ||
  CASE WHEN role <> 'system' THEN ',"layout":{' || CASE WHEN lines > 1 AND length(split_part(text, chr(10), 1)) <= 80 THEN '"title":' || to_json(split_part(text, chr(10), 1)) || ',' ELSE '' END || CASE WHEN lines > 1 THEN '"lines":' || lines || ',' ELSE '' END || '"width":' || width || '}' ELSE '' END ||
  CASE WHEN len(needs) > 0 THEN ',"after":["$' || array_to_string(needs, '","$') || '"]' ELSE '' END || '}' END AS args FROM c1),
r AS MATERIALIZED (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn AS result_turn, text AS content FROM conversations WHERE role = 'user'),
refs AS MATERIALIZED (SELECT DISTINCT conv_id, call_id, substr(json_extract_string(args, '$.after[' || k || ']'), 2) AS needs FROM (SELECT *, unnest(range(0, CAST(json_array_length(args, '$.after') AS BIGINT))) AS k FROM c WHERE json_type(args, '$.after') = 'ARRAY')),
e AS MATERIALIZED (SELECT refs.* FROM refs SEMI JOIN c ON refs.conv_id = c.conv_id AND refs.needs = c.call_id),
astray AS (SELECT DISTINCT conv_id, call_id FROM refs ANTI JOIN c ON refs.conv_id = c.conv_id AND refs.needs = c.call_id),
bad AS (SELECT conv_id, call_id, call_id AS at, 0 AS step FROM c UNION SELECT bad.conv_id, bad.call_id, e.needs, step + 1 FROM bad JOIN e ON bad.conv_id = e.conv_id AND bad.at = e.call_id WHERE step < 40),
lv AS (SELECT conv_id, call_id, max(step) AS level FROM bad GROUP BY ALL HAVING max(step) < 40),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.turn, r.result_turn) AS turn, c.turn AS call_turn, r.result_turn, r.content, c.name, c.args, c.broken, lv.level, a.call_id IS NOT NULL AS astray
  FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.call_id = r.call_id LEFT JOIN lv ON lv.conv_id = c.conv_id AND lv.call_id = c.call_id LEFT JOIN astray a ON a.conv_id = c.conv_id AND a.call_id = c.call_id),
k AS (SELECT *, CASE WHEN name IS NULL THEN NULL WHEN broken THEN 'not an object' ELSE array_to_string(list_sort(list_filter([
      CASE WHEN name <> 'configure' AND json_type(args, '$.layout.width') NOT IN ('UBIGINT', 'BIGINT') THEN 'layout.width is not integer' END,
      CASE WHEN name = 'write' AND NOT json_exists(args, '$.layout.title') THEN 'missing layout.title' END,
      CASE WHEN name = 'configure' AND json_exists(args, '$.after') THEN 'unexpected after' END], lambda x: x IS NOT NULL)), '; ') END AS errors,
    CASE WHEN NOT broken THEN '{' || array_to_string(list_filter([
      '"after":' || json_extract(args, '$.after'),
      CASE WHEN json_exists(args, '$.layout') THEN '"layout":{' || array_to_string(list_filter(['"lines":' || json_extract(args, '$.layout.lines'), '"title":' || json_extract(args, '$.layout.title'), '"width":' || json_extract(args, '$.layout.width')], lambda x: x IS NOT NULL), ',') || '}' END,
      '"text":' || json_extract(args, '$.text')], lambda x: x IS NOT NULL), ',') || '}' END AS arguments FROM j)
SELECT conv_id, call_id, turn, CAST(level AS INTEGER) AS level, CASE WHEN name IS NULL THEN 'no call' WHEN level IS NULL THEN 'circle' WHEN astray THEN 'missing dependency' WHEN errors <> '' THEN 'invalid arguments' WHEN result_turn IS NULL THEN 'no result' ELSE 'linked' END AS status, errors,
  '{"arguments":' || arguments || ',"call_id":"' || call_id || '"' || CASE WHEN content IS NOT NULL THEN ',"content":' || to_json(content) ELSE '' END || CASE WHEN level IS NOT NULL THEN ',"level":' || level ELSE '' END || ',"name":"' || name || '"' || CASE WHEN result_turn IS NOT NULL THEN ',"result_turn":' || result_turn ELSE '' END || ',"turn":' || call_turn || '}' AS json FROM k
"""
