"""Recognisers, risk, quality checks and evaluation."""

import json
import time

import pytest
from pyspark.sql import functions as F

from spanloom.operators import entities, evaluation, quality, risk, safety
from spanloom.operators.entities import Entity, detect
from spanloom.sources import fixtures


def types(text, **more):
    return {e.type for e in detect(text, **more)}


@pytest.mark.parametrize("text", ["seen 20thmay2024", "on 5dec99", "on 20 May 2024", "on May 20, 2024", "on 20-May-2024", "id 20240520"])
def test_dates(text):
    assert "DATE_TIME" in types(text)


@pytest.mark.parametrize("text", ["Reference 12345678 sent.", "Call 5551234567 now", "$1,250.99"])
def test_no_dates(text):
    assert "DATE_TIME" not in types(text)


@pytest.mark.parametrize("text", ["He said that she knew him and her", "his or hers"])
def test_pronouns_are_no_gender(text):
    assert "GENDER" not in types(text)


def test_key_value_gender_scores_high():
    assert max(e.score for e in detect("gender: F")) >= 0.85


@pytest.mark.parametrize(("text", "severity"), [("A man aged 42 years", "none"), ("A man aged 42 years joined a hospital on 20 May 2024", "phi"), ("A man aged 42 years joined a hospital on 20thmay2024", "phi"), ("Email me at jane@example.com", "high"), ("SSN 123-45-6789", "high"), ("", "none"), (None, "none")])
def test_severity(text, severity):
    found = risk.analyze(text)
    assert found["severity"] == severity and found["has_pii"] == (severity != "none")


def mock(text, **spans):
    return [Entity(kind, text.index(part), text.index(part) + len(part), 0.9) for kind, part in spans.items()]


def test_combinations():
    text = "Female, DOB 1985-03-12, ZIP 94103."
    found = mock(text, GENDER="Female", DATE_OF_BIRTH="1985-03-12", ZIP_CODE="94103")
    assert [(v.rule, v.severity) for v in risk.evaluate(text, found)] == [("sweeney_canonical", "high")]
    text = "Patient: " + text
    assert risk.evaluate(text, mock(text, GENDER="Female", DATE_OF_BIRTH="1985-03-12", ZIP_CODE="94103"))[0].severity == "phi"
    for name, rules in (("John Smith", ["name_zip"]), ("John", [])):
        text = f"{name} lives in 94103."
        assert [v.rule for v in risk.evaluate(text, mock(text, PERSON=name, ZIP_CODE="94103")) if v.kind == "qi_combination"] == rules


def test_rules_precede_no_superset():
    sets = [frozenset(rule.types) for rule in risk.RULES]
    assert len(sets) == 16
    for i, one in enumerate(sets):
        assert not any(one < later for later in sets[i + 1 :])


def test_backend_and_policy():
    backend = entities.dictionary_backend({"Paris": "LOCATION", "Anna Berg": "PERSON", "NATO": "ORG"})
    assert types("Anna Berg of NATO in Paris", backend=backend) == {"LOCATION", "PERSON"}
    assert types("mail a@b.co", policy=entities.Policy(enabled={"URL": False, "EMAIL_ADDRESS": False})) == set()
    assert entities.Policy.of({}).score_threshold == 0.7


def test_entities_between_sentences_go_last():
    text = "One.  Two. Three"
    assert [len(own) for *_, own in risk.sentences(text, [Entity("AGE", 4, 5, 1), Entity("AGE", 11, 12, 1)])] == [2]


def test_analyze_texts(spark):
    rows = spark.createDataFrame([(1, "SSN 123-45-6789"), (2, None), (3, ""), (4, "SSN 123-45-6789")], "id long, text string")
    got = {r.id: r.pii for r in risk.analyze_texts(rows).collect()}
    assert got[1] == got[4] and got[1].has_pii and got[1].types["US_SSN"] == 1
    assert not got[2].has_pii and got[3].raw_count == 0


def checked(spark, kind, metadata, status="ok"):
    frame = spark.createDataFrame([("s", kind, status, json.dumps(metadata))], "span_id string, span_type string, span_status string, metadata string")
    return quality.with_mechanical(frame).first()


@pytest.mark.parametrize(("metadata", "expected"), [({"output": ""}, None), ({}, None), ({"output": {"a": 1}}, 1.0), ({"output": "{oops"}, 1.0), ({"output": "null", "format": "json"}, 0.0), ({"output": "words"}, 1.0), ({"output": []}, None)])
def test_format(spark, metadata, expected):
    assert checked(spark, "model_call", metadata).format_correctness == expected


@pytest.mark.parametrize(("metadata", "expected"), [({"output": "{}"}, None), ({"schema": {"required": ["a"]}, "output": {"a": 1}}, 1.0), ({"schema": {"required": ["a"]}, "output": '{"b": 1}'}, 0.0), ({"schema": {"required": ["a"]}, "output": "words"}, 0.0), ({"schema": {"x": 1}, "output": {"x": 0}}, 1.0), ({"expected_schema": {"properties": {"p": {}}}, "output": {"q": 0}}, 0.0)])
def test_schema(spark, metadata, expected):
    assert checked(spark, "model_call", metadata).schema_conformance == expected


def test_tool_calls(spark):
    good = {"tool": "t", "request": {"q": 1}, "response": "r"}
    assert checked(spark, "tool_call", good).tool_call_validity == 1.0
    row = checked(spark, "tool_call", {"tool": " ", "request": "words"})
    assert row.tool_call_validity == 0.0 and json.loads(row.tool_meta)["failed"] == ["missing_tool_name", "malformed_request", "missing_response"]
    assert checked(spark, "tool_call", good | {"response": ""}, "timeout").tool_call_validity == 1.0


def test_completeness_and_accuracy(spark):
    assert checked(spark, "validation", {"input": {"a": 1, "b": "", "c": None, "d": []}}).data_completeness == 0.25
    assert checked(spark, "validation", {"input": "{}"}).data_completeness is None
    assert checked(spark, "skill_exec", {"records_processed": 7, "batch_size": 3}).data_completeness == 1.0
    assert checked(spark, "skill_exec", {"records_processed": 7, "batch_size": 0}).data_completeness is None
    row = checked(spark, "validation", {"input": {"a": 1, "b": 2}, "output": {"errors": ["x"]}})
    assert row.data_accuracy == 0.5 and json.loads(row.accuracy_meta) == {"errors": ["x"]}
    assert checked(spark, "validation", {"output": {"ok": 1}}).data_accuracy is None


@pytest.mark.parametrize(("constraints", "value", "meta"), [({}, None, None), ({"max_chars": 3}, 0.0, {"violated": ["max_chars"]}), ({"min_words": 2, "contains": ["one"]}, 1.0, None), ({"not_contains": "two"}, 0.0, {"violated": ["not_contains"]}), ({"tone": "kind"}, None, {"unchecked": ["tone"]}), ({"tone": "kind", "max_words": 9}, 1.0, {"unchecked": ["tone"]}), ({"max_chars": "x", "min_chars": 1}, 1.0, {"unchecked": ["max_chars"]})])
def test_constraints(spark, constraints, value, meta):
    row = checked(spark, "model_call", {"output": "one two", "constraints": constraints})
    assert row.constraint_satisfaction == value
    assert (json.loads(row.constraint_meta) if row.constraint_meta else None) == meta


def test_sentences(spark):
    text = "One here. Two!  Three?\nFour\n\nok"
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(quality.split_sentences("t")).first()[0] == quality.sentences_of(text) == ["One here.", "Two!", "Three?", "Four"]
    assert quality.normalized_output('{"a_b": {"c": 1}, "d": [2, 3]}') == "a b c is 1.\nd is 2.\nd is 3."


def test_recipes():
    words = ["red", "blue", "green"]
    embed = lambda texts: [[float(w in t) for w in words] for t in texts]
    scorer = quality.RecipeScorer(lambda pairs: [(float(h in p), 0.25) for p, h in pairs], embed, lambda pairs: [0.0 for _ in pairs])
    row = scorer.generation([("A red one. A blue one.", "A red one. Some blue.")])[0]
    assert row["faithfulness"] == 0.5 and row["coherence"] == 0.75 and row["completeness"] == pytest.approx(1.0)
    row = scorer.retrieval([("q", ["red", "green"], "all red here")])[0]
    assert row["context_relevance"] == 0.5 and row["chunk_utilization"] == 0.5
    assert scorer.retrieval([("q", ["red"], None)])[0]["chunk_utilization"] is None


def test_softmax_labels():
    assert safety.from_logits(["SAFE", "INJECTION"], [0.0, 0.0], safety.INJECTION_LABELS) == 0.5


def test_span_matching(spark):
    gold = [{"type": "A", "start": 0, "end": 10}, {"type": "A", "start": 20, "end": 30}, {"type": "B", "start": 0, "end": 4}]
    predicted = [{"type": "A", "start": 1, "end": 10}, {"type": "A", "start": 0, "end": 10}, {"type": "B", "start": 3, "end": 9}]
    assert evaluation.match_spans(predicted, gold) == {"A": (1, 1, 1), "B": (0, 1, 1)}
    shape = "array<struct<type:string,start:bigint,end:bigint>>"
    frame = spark.createDataFrame([(predicted, gold), (None, None)], f"predicted {shape}, gold {shape}")
    got = {r.type: (r.tp, r.fp, r.fn) for r in evaluation.span_scores(frame).collect()}
    assert got == {"A": (1, 1, 1), "B": (0, 1, 1), "ALL": (1, 2, 2)}


def test_bio(spark, tmp_path):
    path = tmp_path / "gold.csv"
    path.write_text('document,text,tokens,labels,trailing_whitespace\n1,Ann Lee of X,"[\'Ann\', \'Lee\', \'of\', \'X\']","[\'B-NAME\', \'I-NAME\', \'O\', \'O\']","[True, True, True, False]"\n')
    row = evaluation.bio_csv(spark, str(path), {"NAME": "PERSON"}).first()
    assert [(g.type, g.start, g.end) for g in row.gold] == [("PERSON", 0, 7)]


def test_auprc(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1)], "score double, label int")
    assert evaluation.auprc(rows).first().auprc == pytest.approx((1 + 2 / 3) / 2)
    assert evaluation.auroc(rows).first().auroc == 0.5
    assert evaluation.at_threshold(rows.limit(0), 0.5).first().f1 == 0.0
    ranked = spark.createDataFrame([(1, 2), (2, 4), (3, 9)], "a int, b int")
    assert evaluation.spearman(ranked, "a", "b").select(F.round("spearman", 6)).first()[0] == 1.0


def test_gold_sets(spark, tmp_path):
    from spanloom.sources import gold

    (tmp_path / "qa.jsonl").write_text('{"knowledge": "k", "question": "q", "right_answer": "r", "hallucinated_answer": "h"}\n' * 3)
    rows = gold.question_answers(spark, str(tmp_path / "qa.jsonl"))
    assert sorted((r.premise, r.hypothesis, r.label) for r in rows.distinct().collect()) == [("k q", "h", 0), ("k q", "r", 1)]
    assert gold.balanced(rows, 2).count() == 4
    spark.createDataFrame([("q", (["a", "b"], [0, 1]))], "query string, passages struct<passage_text:array<string>,is_selected:array<int>>").write.parquet(str(tmp_path / "p"))
    assert sorted((r.passage, r.label) for r in gold.passages(spark, str(tmp_path / "p")).collect()) == [("a", 0), ("b", 1)]
    spark.createDataFrame([("t", ["x", "y"], [1.0, 2.0], [3.0, 4.0])], "text string, machine_summaries array<string>, coherence array<double>, relevance array<double>").write.parquet(str(tmp_path / "s"))
    assert [(r.summary, r.coherence, r.relevance) for r in gold.summaries(spark, str(tmp_path / "s")).orderBy("summary").collect()] == [("x", 1.0, 3.0), ("y", 2.0, 4.0)]


def test_cli(tmp_path, capsys):
    from spanloom import cli

    (tmp_path / "t.txt").write_text("SSN 123-45-6789")
    assert cli.main(["analyze", str(tmp_path / "t.txt"), "--evaluate"]) == 0
    assert "US_SSN 4-15" in capsys.readouterr().out
    assert cli.main(["analyze", str(tmp_path / "t.txt"), "--format", "json", "--output", str(tmp_path / "o.json")]) == 0
    assert json.loads((tmp_path / "o.json").read_text())["entities"][0]["type"] == "US_SSN"
    assert cli.main(["specs"]) == 0 and len(capsys.readouterr().out.splitlines()) == 50


def test_addresses_in_linear_time():
    found = lambda text: [text[e.start : e.end] for e in entities.detect(text) if e.type == "EMAIL_ADDRESS"]
    assert found("x me@a.com, .b@c.de ..d@e.fr joe.x+1@q-r.co.uk") == ["me@a.com", "b@c.de", "d@e.fr", "joe.x+1@q-r.co.uk"]
    began = time.perf_counter()
    assert found("a." * 250_000) == []
    assert time.perf_counter() - began < 20


def test_analysers_only_see_spans_whose_toggles_ask_for_them(spark, sf):
    keys = "scope string, solution_id string, endpoint string, workflow_id string, agent_id string, component_id string, metric string"
    on = lambda metric, component="model_gpt4o": spark.createDataFrame([("component", "sol_0", "", "", "", component, metric)], keys)
    spans = fixtures.spans_from_conversations(spark, sf)
    scored = lambda active: quality.with_semantic(spans, quality.StaticScorer(), active=active).agg(F.count("*"), F.count("faithfulness"), F.count("context_relevance")).first()
    n, made, found = scored(None)
    assert n == spans.count() and made and found
    assert tuple(scored(on("coherence"))) == (n, made, 0)
    assert tuple(scored(on("context_relevance", "kb_product_docs"))) == (n, 0, found)
    assert tuple(scored(on("latency"))) == (n, 0, 0)
    documents, stub = fixtures.spans_from_documents(spark, sf), safety.KeywordClassifier({}, {"the": 0.9, "idiot": 0.9})
    flagged = lambda active: safety.with_safety(documents, classifier=stub, active=active).agg(F.count("*"), F.sum("toxicity_detected")).first()
    n, toxic = flagged(None)
    assert toxic > 0 and tuple(flagged(on("pii_detected"))) == (n, toxic) and tuple(flagged(on("latency"))) == (n, 0)
