"""Queries of decisions, validation of answers, and gates."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from loomwright.functions import validation
from loomwright.operators import decisions, gates
from loomwright.plans.queries import query
from loomwright.sources.tables import table

DECISION_ROWS_SQL = """d AS (
        SELECT event_id, CASE WHEN event_id % 23 = 0 THEN user_id END AS assigned, CASE WHEN event_id % 11 <> 0 THEN ((event_id * 37) % 100) / 100.0::DOUBLE END AS best,
            CASE WHEN event_id % 11 <> 0 AND event_id % 4 <> 0 THEN ((event_id * 37) % 100 - (event_id * 11) % 9) / 100.0::DOUBLE END AS second, ((event_id * 53) % 100) / 100.0::DOUBLE AS model,
            user_id % 6 = 0 AS token, CASE WHEN event_id % 7 < 3 THEN 'same_event' WHEN event_id % 7 < 5 THEN 'unclear' ELSE 'not_same_event' END AS relationship, ((event_id * 29) % 40 + 60) / 100.0::DOUBLE AS confidence
        FROM events
    )"""


def decision_rows(spark, sf_dir):
    """Events in the role of articles with scores of their candidates."""
    i, of = F.col("event_id"), lambda n: n / F.lit(100.0)
    best, some = (i * 37) % 100, i % 11 != 0
    return table(spark, sf_dir, "events").select(
        i, F.when(i % 23 == 0, F.col("user_id")).alias("assigned"), F.when(some, of(best)).alias("best"), F.when(some & (i % 4 != 0), of(best - (i * 11) % 9)).alias("second"), of((i * 53) % 100).alias("model"),
        (F.col("user_id") % 6 == 0).alias("token"), F.when(i % 7 < 3, "same_event").when(i % 7 < 5, "unclear").otherwise("not_same_event").alias("relationship"), of((i * 29) % 40 + 60).alias("confidence"),
    )


@query(f"""WITH {DECISION_ROWS_SQL}, a AS (
        SELECT *, best IS NOT NULL AND assigned IS NULL AND (token OR model >= 0.6 OR (best >= 0.68 AND model >= 0.3)) AS asked, coalesce(best - second < 0.035, false) AS competing FROM d
    ), m AS (
        SELECT *, asked AND relationship = 'same_event' AND NOT competing AND ((best >= 0.7 AND model >= 0.55 AND confidence >= 0.9) OR (token AND model >= 0.35 AND confidence >= 0.88)) AS merges FROM a
    ), r AS (
        SELECT *, concat_ws('; ', CASE WHEN asked AND relationship = 'same_event' AND NOT merges THEN 'Qwen identifies a possible same event, but auto-merge thresholds are not met' END,
            CASE WHEN asked AND relationship = 'same_event' AND NOT merges AND competing THEN 'more than one event remains plausible' END,
            CASE WHEN asked AND relationship = 'unclear' AND (token OR best >= 0.72 OR model >= 0.55) THEN 'Qwen is unclear despite meaningful candidate-event evidence' END,
            CASE WHEN asked AND relationship = 'not_same_event' AND ((token AND model >= 0.6) OR (best >= 0.82 AND model >= 0.7)) THEN 'exceptionally strong non-LLM evidence conflicts with Qwen not-same decision' END) AS reasons FROM m
    )
    SELECT event_id, asked, competing, CASE WHEN assigned IS NOT NULL THEN 'existing_assignment' WHEN best IS NULL THEN 'new_event' WHEN merges THEN 'auto_merge' WHEN reasons <> '' THEN 'review' ELSE 'new_event' END AS decision,
        assigned IS NULL AND best IS NOT NULL AND NOT merges AND reasons <> '' AS requires_review, CASE WHEN assigned IS NULL AND best IS NOT NULL AND NOT merges AND reasons <> '' THEN reasons END AS review_reason FROM r""")
def event_decisions(spark, sf_dir):
    """Whether an article merges into its best event, is reviewed, or is an event of its own, and why."""
    return decisions.resolved(decision_rows(spark, sf_dir)).select("event_id", "asked", "competing", "decision", "requires_review", "review_reason")


@query(f"""WITH {DECISION_ROWS_SQL}, e AS (SELECT event_id, model, model * exp(-0.2 * (event_id % 5)) AS adjusted, relationship FROM d)
    SELECT event_id, round(adjusted, 6) AS adjusted, CASE WHEN adjusted >= 0.45 AND relationship = 'same_event' THEN 'same_event' WHEN adjusted < 0.45 AND relationship <> 'same_event' THEN 'not_same' ELSE 'review' END AS verdict FROM e""")
def verifier_ensemble(spark, sf_dir):
    """What a pair model, its score decayed by days, and a verifier agree on."""
    adjusted, verdict = decisions.ensemble(F.col("model"), F.col("event_id") % 5, F.col("relationship"))
    return decision_rows(spark, sf_dir).select("event_id", F.round(adjusted, 6).alias("adjusted"), verdict.alias("verdict"))


def answer(**changes: object) -> str:
    """A legal answer with some fields changed; a field changed to `...` is left out. The place of its confidence is marked."""
    dims = {"creative": {"present": True, "direction": "expanding", "degree": 2, "confidence": 0.5, "reasoning": " c "}}
    dims |= {d: {"present": False, "confidence": 0.1} for d in ("agentic", "normative", "operational")}
    legal: dict = {
        "ai_relevant": True, "empowerment_status": "expanding", "empowerment_degree": 2, "narrative_frame": "opportunity", "distribution_breadth": "broad", "dominant_dimension": "creative",
        "ai_authority_shift": "increasing", "topic": "healthcare", "geographic_scope": "country", "country_iso3s": ["nld"], "confidence": "CONFIDENCE", "reasoning": " so ", "dimensions": dims,
    }
    for name, value in changes.items():
        if name in dims:
            dims[name] = dims[name] | value if isinstance(value, dict) else value
        else:
            legal[name] = value
    return json.dumps({k: v for k, v in legal.items() if v is not ...}).replace('"CONFIDENCE"', "CONFIDENCE")


#: For each rule an answer that meets it, and what comes out: status, degree, frame, breadth, dominant, authority, topic, scope, countries, issues, fault.
CLEAN = {"status": "expanding", "degree": 2, "frame": "opportunity", "breadth": "broad", "dominant": "creative", "authority": "increasing", "topic": "healthcare", "scope": "country", "countries": "NLD", "relevant": True, "creative": "expanding 2", "issues": "", "fault": None}
RULES: list[tuple[str, dict]] = [
    (answer(), {}),
    (answer(empowerment_status="better"), {"status": "unclear", "degree": 0, "issues": "status invalid"}),
    (answer(empowerment_status=None), {"status": "unclear", "degree": 0}),
    (answer(empowerment_status="unclear", empowerment_degree=3), {"status": "unclear", "degree": 0}),
    (answer(empowerment_degree=9), {"degree": 3}),
    (answer(empowerment_degree="2"), {}),
    (answer(empowerment_degree="two"), {"degree": 1, "issues": "degree invalid; degree raised from 0 to 1"}),
    (answer(empowerment_degree=...), {"degree": 1, "issues": "degree raised from 0 to 1"}),
    (answer(empowerment_degree=-1), {"degree": 1, "issues": "degree raised from 0 to 1"}),
    (answer(empowerment_degree=1.9), {"degree": 1}),
    (answer(empowerment_degree=None), {"degree": 1, "issues": "degree invalid; degree raised from 0 to 1"}),
    (answer(narrative_frame="hype"), {"frame": "unclear", "issues": "frame invalid"}),
    (answer(distribution_breadth=5), {"breadth": "unclear", "issues": "breadth invalid"}),
    (answer(distribution_breadth=""), {"breadth": "unclear"}),
    (answer(dominant_dimension="none"), {"dominant": None}),
    (answer(dominant_dimension="social"), {"fault": "dominant dimension unknown"}),
    (answer(dominant_dimension="agentic"), {"dominant": None, "issues": "dominant dimension not present"}),
    (answer(ai_authority_shift="sideways"), {"authority": "unclear", "issues": "authority invalid"}),
    (answer(topic="sports"), {"topic": "other", "issues": "topic invalid"}),
    (answer(topic=...), {"topic": "other"}),
    (answer(geographic_scope="city"), {"scope": "unclear", "issues": "scope invalid"}),
    (answer(geographic_scope="global"), {"scope": "global", "countries": ""}),
    (answer(country_iso3s=["nld", "FR-A"]), {}),
    (answer(geographic_scope="multi_country", country_iso3s=["nld", "FR-A", "NLD", "xy", 12, None]), {"scope": "multi_country", "countries": "NLD,FRA"}),
    (answer(country_iso3s="nld"), {"scope": "unclear", "countries": "", "issues": "scope without country"}),
    (answer(country_iso3s=[]), {"scope": "unclear", "countries": "", "issues": "scope without country"}),
    (answer(confidence=None), {"fault": "overall confidence missing"}),
    (answer(confidence="high"), {"fault": "overall confidence not a number"}),
    (answer(confidence=1.5), {"fault": "overall confidence out of range"}),
    (answer(ai_relevant=False), {"relevant": False}),
    (answer(ai_relevant=...), {}),
    (answer(ai_relevant=None), {"relevant": False}),
    (answer(creative={"direction": "not_present"}), {"fault": "creative present without direction"}),
    (answer(creative={"direction": "up"}), {"fault": "creative direction invalid"}),
    (answer(creative={"degree": "x"}), {"fault": "creative degree invalid"}),
    (answer(creative={"degree": 7, "direction": " mixed "}), {"creative": "mixed 3"}),
    (answer(agentic={"confidence": 2}), {"fault": "agentic confidence out of range"}),
    (answer(normative="yes"), {"fault": "normative confidence missing"}),
    (answer(dimensions=[]), {"fault": "agentic confidence missing"}),
    (answer(creative={"present": False}), {"dominant": None, "creative": "- 0", "issues": "dominant dimension not present"}),
    (answer(empowerment_status="non_empowerment"), {"status": "non_empowerment", "degree": 0, "dominant": None, "creative": "- 0", "issues": "present dimension without empowerment"}),
    (answer(empowerment_status="non_empowerment", dominant_dimension="none", creative={"present": 0}), {"status": "non_empowerment", "degree": 0, "dominant": None, "creative": "- 0"}),
    ("no object", {"fault": "no object"}),
]


def expected_sql() -> str:
    """The table of what each rule gives, as VALUES."""
    show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    rows = []
    for n, (_, changes) in enumerate(RULES):
        want = CLEAN | changes
        if want["fault"]:
            want = {k: want[k] if k == "fault" else None for k in want}
        rows.append(f"({n}, {', '.join(show(v) for v in want.values())})")
    return f"(VALUES {', '.join(rows)}) AS w(n, {', '.join(f'w_{k}' for k in CLEAN)})"


@query(f"""WITH w AS (SELECT * FROM {expected_sql()}), e AS (SELECT event_id, event_id % {len(RULES)} AS n, (event_id % 101) / 100.0::DOUBLE AS confidence FROM events)
    SELECT event_id, w_relevant AS ai_relevant, w_status AS status, w_degree AS degree, CASE w_status WHEN 'expanding' THEN round(w_degree / 3.0::DOUBLE, 6) WHEN 'non_empowerment' THEN 0.0::DOUBLE END AS unit_score, w_frame AS frame, w_breadth AS breadth,
        w_dominant AS dominant, w_authority AS authority, w_topic AS topic, w_scope AS scope, w_countries AS countries, nullif(split_part(w_countries, ',', 1), '') AS primary_country, CASE WHEN w_fault IS NULL THEN confidence END AS confidence, w_creative AS creative,
        w_issues AS issues, w_issues <> '' OR w_status = 'unclear' AS requires_review, concat_ws('; ', nullif(w_issues, ''), CASE WHEN w_status = 'unclear' THEN 'empowerment status unclear' END) AS review_reason, w_fault AS fault
    FROM e JOIN w ON e.n = w.n WHERE w_fault IS NULL UNION ALL
    SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, w_fault FROM e JOIN w ON e.n = w.n WHERE w_fault IS NOT NULL""")
def validated_answers(spark, sf_dir):
    """Answers of a model in legal form, with issues; answers that can't be taken have a fault and nothing else."""
    sure = ((F.col("event_id") % 101) / F.lit(100.0)).cast("string")
    said = F.replace(F.element_at(F.array(*[F.lit(text) for text, _ in RULES]), (F.col("event_id") % len(RULES) + 1).cast("int")), F.lit("CONFIDENCE"), sure)
    rows = validation.validated(table(spark, sf_dir, "events").select("event_id", said.alias("answer")), "answer")
    creative = F.concat_ws(" ", F.coalesce("creative.direction", F.lit("-")), F.col("creative.degree").cast("string"))
    found = F.col("fault").isNull()
    return rows.select(
        "event_id", "ai_relevant", "status", "degree", "unit_score", "frame", "breadth", "dominant", "authority", "topic", "scope", F.array_join("countries", ",").alias("countries"), "primary_country",
        "confidence", F.when(found, creative).alias("creative"), F.array_join("issues", "; ").alias("issues"), "requires_review", "review_reason", "fault",
    )


# Gates


@query("""SELECT 'order_without_lines' AS gate, count(*) AS violations FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'line_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'discount_out_of_range', count(*) FROM lineitem WHERE NOT l_discount BETWEEN 0 AND 1 UNION ALL SELECT 'order_key_not_unique', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def integrity_gates(spark, sf_dir):
    """Rules over keys and values of two tables, each read once."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("orders"))
    outside = F.count(F.when(~F.col("l_discount").between(0, 1), 1))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("lines"), outside.alias("outside"))
    keys = orders.join(lines, "key", "full_outer")
    return gates.counted(keys, [
        gates.Rule("order_without_lines", F.col("lines").isNull(), F.col("orders")), gates.Rule("line_without_order", F.col("orders").isNull(), F.col("lines")),
        gates.Rule("discount_out_of_range", F.coalesce("outside", F.lit(0)) > 0, F.col("outside")), gates.Rule("order_key_not_unique", F.coalesce("orders", F.lit(1)) > 1),
    ])


@query("""SELECT event_id, gate FROM (SELECT event_id, 'value_out_of_range' AS gate FROM events WHERE NOT coalesce(value BETWEEN 0 AND 40, false) UNION ALL SELECT event_id, 'direction_without_degree' FROM events WHERE event_type IN ('purchase', 'error') AND user_id % 4 = 0
    UNION ALL SELECT event_id, 'degree_without_direction' FROM events WHERE event_type NOT IN ('purchase', 'error') AND user_id % 4 <> 0 AND event_id % 3 = 0 UNION ALL SELECT event_id, 'no_properties' FROM events WHERE json_extract_string(props, '$.k') IS NULL OR json_extract_string(props, '$.k')::BIGINT > 95)""")
def rule_violators(spark, sf_dir):
    """Rows that break a rule, once for each rule; a rule of two fields holds in both directions."""
    directional, degree = F.col("event_type").isin("purchase", "error"), F.col("user_id") % 4
    rules = [
        gates.Rule("value_out_of_range", ~F.col("value").between(0, 40)), gates.Rule("direction_without_degree", directional & (degree == 0)),
        gates.Rule("degree_without_direction", ~directional & (degree != 0) & (F.col("event_id") % 3 == 0)), gates.Rule("no_properties", F.get_json_object("props", "$.k").cast("long") > 95),
    ]
    return gates.violators(table(spark, sf_dir, "events"), ["event_id"], rules)


@query("""WITH n AS (SELECT o_orderkey, count(DISTINCT l_suppkey) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'N') AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT 'no_active_event' AS gate, count(*) AS violations FROM n WHERE n = 0 UNION ALL SELECT 'several_active_events', count(*) FROM n WHERE n > 1""")
def one_event_gate(spark, sf_dir):
    """Every article has exactly one active event: orders as articles, suppliers of open lines as the events they are linked to."""
    active = F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.col("l_suppkey"))
    # Two different ones are enough to know, so nothing is collected.
    links = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(active).alias("low"), F.max(active).alias("high"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(links, "o_orderkey", "left")
    return gates.counted(rows, [gates.Rule("no_active_event", F.col("low").isNull()), gates.Rule("several_active_events", F.coalesce(F.col("low") < F.col("high"), F.lit(False)))])


@query("""WITH a AS (SELECT l.doc_id, l.quality, d.source AS run, d.n_chars FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id), m AS (SELECT doc_id FROM documents WHERE n_chars % 3 <> 0)
    SELECT 'rows_missing' AS gate, greatest(0, 100 - count(*)) AS violations FROM a UNION ALL SELECT 'row_without_run', count(*) FROM a WHERE run IS NULL UNION ALL SELECT 'several_runs', greatest(0, count(DISTINCT run) - 1) FROM a
    UNION ALL SELECT 'correction_without_entry', count(*) FROM a WHERE quality = 0 AND doc_id NOT IN (SELECT doc_id FROM m) UNION ALL SELECT 'entry_without_correction', count(*) FROM m WHERE doc_id NOT IN (SELECT doc_id FROM a WHERE quality = 0)""")
def audit_gates(spark, sf_dir):
    """An audit has its rows, of one run, and a manifest names each correction and nothing else: labels as the audit, documents as manifest."""
    audit = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("run"), (F.col("n_chars") % 3 != 0).alias("entry"))
    rows = audit.withColumn("audited", F.lit(True)).join(docs, "doc_id", "full_outer")
    audited, correction, entry = F.coalesce("audited", F.lit(False)), F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce("entry", F.lit(False))
    counts = gates.counted(rows, [
        gates.Rule("row_without_run", audited & F.col("run").isNull()), gates.Rule("correction_without_entry", correction & ~entry), gates.Rule("entry_without_correction", entry & ~correction),
    ])
    runs = rows.filter(audited).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    of_runs = runs.agg(F.greatest(F.lit(0), 100 - F.coalesce(F.sum("n"), F.lit(0))).alias("rows_missing"), F.greatest(F.lit(0), F.count("run") - 1).alias("several_runs"))
    return counts.union(of_runs.selectExpr("stack(2, 'rows_missing', rows_missing, 'several_runs', several_runs) AS (gate, violations)"))
