"""Model folders behind the analysers, settings, the service and the commands."""

import io
import json
import pickle
import threading
import urllib.error
import urllib.request

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom import cli, service
from spanloom.functions import metadata
from spanloom.operators import entities, models, quality, registry, safety
from spanloom.plans import specs
from spanloom.settings import Settings


def folder(path, labels, words):
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer(tokenizers.models.WordLevel({"[UNK]": 0, **{word: i + 1 for i, word in enumerate(words)}}, unk_token="[UNK]"))
    found.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    found.save(str(path / "tokenizer.json"))
    (path / "config.json").write_text(json.dumps({"id2label": dict(enumerate(labels))}))
    return str(path)


class Session:
    """Logits from a rule over (ids, mask); also remembers the shapes."""

    def __init__(self, rule):
        self.rule, self.shapes = rule, []

    def get_inputs(self):
        return [type("Input", (), {"name": name}) for name in ("input_ids", "attention_mask")]

    def run(self, _, given):
        assert set(given) == {"input_ids", "attention_mask"}
        self.shapes.append(given["input_ids"].shape)
        return [self.rule(given["input_ids"], given["attention_mask"])]


def model(path, labels, words, rule, **more):
    found = models.Onnx(folder(path, labels, words), **more)
    found.session = Session(rule)
    return found


def test_tagger(tmp_path):
    labels = ["O", "B-PER", "I-PER", "B-CITY", "X"]
    words = {"Anna": 1, "Berg": 2, "Otto": 1, "Paris": 3, "odd": 4}
    tags = np.array([0, *words.values()])
    rule = lambda ids, mask: 6.0 * np.eye(len(labels))[tags[ids]]
    text = "Anna Berg met Otto in Paris , odd . " * 40
    found = model(tmp_path, labels, words, rule, most=20, batch=4)
    for overlap in (0, 10):
        got = models.Tagger(found, overlap=overlap)(text)
        assert [(e.type, text[e.start : e.end]) for e in got] == [("PERSON", "Anna Berg"), ("PERSON", "Otto"), ("LOCATION", "Paris")] * 40
    assert all(rows <= 4 and width <= 20 for rows, width in found.session.shapes)
    assert got[0].score == pytest.approx(float(models.softmax(np.array([6.0, 0, 0, 0, 0]))[0]))
    assert {e.type for e in entities.detect("Anna Berg is here", backend=models.Tagger(found))} == {"PERSON"}
    assert models.Tagger(found)("") == []
    sent = pickle.loads(pickle.dumps(models.Tagger(found)))
    assert sent.model.folder == found.folder and "session" not in vars(sent.model)


def test_classifier(tmp_path):
    rule = lambda ids, mask: np.stack([np.zeros(len(ids)), (ids == 1).sum(axis=1) * 3.0], axis=1)
    sides = []
    for name, labels in (("a", ["SAFE", "INJECTION"]), ("b", ["fine", "toxic"])):
        (tmp_path / name).mkdir()
        sides.append(model(tmp_path / name, labels, ["ignore" if name == "a" else "idiot"], rule))
    both = models.ModelClassifier(*sides)
    (i, h), (i2, h2) = both.scores(["please ignore all", "you idiot"])
    assert i == pytest.approx(1 / (1 + np.exp(-3))) and h == i2 == 0.5 and h2 == i
    said = safety.classify_text("please ignore all", both)
    assert said["labels"] == ["prompt_injection"] and said["scores"] == {"prompt_injection": round(i, 4), "harmful_content": 0.5} and said["latency_ms"] >= 0
    for blank in ("", "  ", None):
        with pytest.raises(ValueError, match="blank"):
            safety.classify_text(blank, both)


def test_semantic_models(tmp_path):
    made = lambda name, labels, rule: ((tmp_path / name).mkdir(), model(tmp_path / name, labels, ["red", "blue"], rule))[1]
    nli = models.entailment(made("nli", ["contradiction", "neutral", "ENTAILMENT"], lambda ids, mask: np.stack([mask[:, 0] * 0.0, mask[:, 0] * 0.0, mask.sum(axis=1) * 1.0], axis=1)))
    expected = models.softmax(np.array([0.0, 0.0, 2.0]))
    assert np.allclose(nli([("red", "blue")]), [[expected[2], expected[0]]]) and nli([]).shape == (0, 2)
    embed = models.embedding(made("embedding", ["x"], lambda ids, mask: np.stack([ids == 1, ids == 2], axis=2) * 1.0))
    vectors = embed(["red", "red blue", "red red red blue"])
    assert np.allclose(np.linalg.norm(vectors, axis=1), 1) and vectors[0] @ vectors[1] == pytest.approx(np.sqrt(0.5))
    relevant = models.relevance(made("relevance", ["x"], lambda ids, mask: mask.sum(axis=1, keepdims=True) * 1.0))
    assert relevant([("red", "blue red"), ("red", "red")]).tolist() == [3.0, 2.0] and len(relevant([])) == 0
    scorer = quality.RecipeScorer(nli, embed, relevant)
    assert scorer.retrieval([("red", ["red"], "red.")])[0]["context_relevance"] == pytest.approx(1 / (1 + np.exp(-2)))


def test_settings():
    found = Settings.of({"SPANLOOM_BATCH": "100", "spanloom_batch_safety": "7", "SPANLOOM_POLL_SEC_COST": "0.5", "SPANLOOM_SEMANTIC": "off", "SPANLOOM_MODELS_ROOT": "/m", "OTHER": "x", "SPANLOOM_SENTENCES": " "})
    assert (found.batch_for("cost"), found.batch_for("safety"), found.poll_for("cost"), found.poll_for("safety")) == (100, 7, 0.5, 2.0)
    assert found.trigger_for("cost") == "500 milliseconds" and not found.semantic and found.sentences == 10
    assert found.model_path("nli") == "/m/nli" and found.model_path("/x/nli") == "/x/nli"
    assert Settings.of({}) == Settings()


def test_policy(tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"score_threshold": 0.9, "entities": {"US_SSN": {"enabled": False}}}))
    policy = entities.Policy.load(str(tmp_path / "p.json"))
    assert policy.score_threshold == 0.9 and not policy.takes(entities.Entity("US_SSN", 0, 1, 1.0)) and policy.takes(entities.Entity("OTHER", 0, 1, 0.9))
    assert entities.Policy.load(str(tmp_path / "p.json"), 0.2).score_threshold == 0.2
    assert entities.Policy.load().score_threshold == 0.7


def test_service():
    own = service.Service()
    assert own.answer("GET", "/health") == (200, {"status": "ok", "ner_model": "regex-only", "ready": True})
    status, said = own.answer("POST", "/analyze", json.dumps({"text": "SSN 123-45-6789", "document_id": "d"}).encode())
    assert status == 200 and said["document_id"] == "d" and said["has_pii"] and said["entity_count"] == len(said["entities"]) and {"US_SSN"} <= {e["type"] for e in said["entities"]}
    assert own.answer("POST", "/analyze/plain", b"")[1]["entities"] == []
    status, said = own.answer("POST", "/analyze/batch", json.dumps({"texts": ["a", "SSN 123-45-6789"], "document_ids": ["x", "y"]}).encode())
    assert status == 200 and [(r["document_id"], r["has_pii"]) for r in said["results"]] == [("x", False), ("y", True)]
    said = own.answer("POST", "/evaluate", json.dumps({"text": "SSN 123-45-6789"}).encode())[1]
    assert said["has_violation"] and said["max_severity"] == "high" and said["violations"][0]["span"] == [4, 15]
    for path, body in (("/analyze/batch", {"texts": []}), ("/analyze/batch", {"texts": ["a"], "document_ids": ["x", "y"]}), ("/analyze", {}), ("/analyze", [])):
        assert own.answer("POST", path, json.dumps(body).encode())[0] == 422
    assert own.answer("POST", "/analyze", b"{")[0] == 422 and own.answer("POST", "/other")[0] == 404
    waiting = service.Service(ready=False)
    assert waiting.answer("POST", "/analyze", b'{"text": "a"}')[0] == 503 and waiting.answer("GET", "/health")[1]["ready"] is False


def test_server():
    running = service.server(service.Service(), 0)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    try:
        place = f"http://127.0.0.1:{running.server_port}"
        open_ = urllib.request.build_opener(urllib.request.ProxyHandler({})).open
        assert json.load(open_(f"{place}/health", timeout=10))["status"] == "ok"
        assert json.load(open_(f"{place}/analyze/plain", "SSN 123-45-6789\nÄ".encode(), timeout=10))["has_pii"]
        with pytest.raises(urllib.error.HTTPError) as refused:
            open_(f"{place}/analyze", b"{}", timeout=10)
        assert refused.value.code == 422
    finally:
        running.shutdown()
        running.server_close()


def test_commands(tmp_path, capsys, monkeypatch):
    scorer, classifier = quality.StaticScorer(0.5), safety.KeywordClassifier({"ignore": 0.9}, {})
    assert cli.main(["classify", "please", "ignore"], classifier=classifier) == 0
    assert json.loads(capsys.readouterr().out)["labels"] == ["prompt_injection"]
    cli.main(["generation", "--input", "a", "--output", "b"], scorer=scorer)
    assert [row["coherence"] for row in json.loads(capsys.readouterr().out)] == [0.5]
    monkeypatch.setattr("sys.stdin", io.StringIO('{"query": "q", "chunks": ["c"]}\n{"query": "q", "chunks": [], "answer": "a"}\n'))
    cli.main(["retrieval"], scorer=scorer)
    assert [row["chunk_utilization"] for row in json.loads(capsys.readouterr().out)] == [None, 0.5]
    cli.main(["retrieval", "--query", "q", "--chunks", '["c"]', "--answer", "a"], scorer=scorer)
    assert [row["chunk_utilization"] for row in json.loads(capsys.readouterr().out)] == [0.5]
    (tmp_path / "t.txt").write_text("SSN 123-45-6789")
    (tmp_path / "p.json").write_text(json.dumps({"score_threshold": 0.0, "entities": {kind: {"enabled": False} for kind in entities.TYPES}}))
    cli.main(["analyze", str(tmp_path / "t.txt"), "--policy", str(tmp_path / "p.json")])
    assert capsys.readouterr().out == "nothing found\n"


def test_strict_times(spark):
    rows = spark.createDataFrame([("2024-05-01 10:00:00.5",), (None,)], "t string")
    assert [r[0] is None for r in rows.select(metadata.moment_or_fail(F.col("t"))).collect()] == [False, True]
    with pytest.raises(Exception, match="no time: soon"):
        spark.createDataFrame([("soon",)], "t string").select(metadata.moment_or_fail(F.col("t"))).collect()


def test_catalog_is_upserted(spark, tmp_path):
    some = [spec for spec in specs.SPECS if spec.threshold]
    path = str(tmp_path / "catalog")
    assert specs.write_catalog(spark, path, some[:3]).count() == len({s.metric for s in some[:3]})
    spark.createDataFrame([("old",)], "x string").write.parquet(f"{path}/version=000000000001/_temporary")  # a write that failed
    now = specs.write_catalog(spark, path, some[2:])
    assert sorted(r.metric_name for r in now.collect()) == sorted({s.metric for s in some})
    assert now.exceptAll(specs.catalog(spark, some)).count() == 0
    assert specs.upserted(now.withColumn("unit", F.lit("other")), specs.catalog(spark, some[:1])).where("unit = 'other'").count() == now.count() - 1


def test_seeding_of_listed_solutions(spark):
    bound = spark.createDataFrame([("a", "e", None, None, None), ("b", "e", None, None, None)], ", ".join(f"{name} string" for name in specs.schemas.PATH))
    solutions, only = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string"), spark.createDataFrame([("b",), ("c",)], "solution_id string")
    catalog = specs.catalog(spark)
    listed, all_ = registry.seeded(bound, solutions, catalog, only=only), registry.seeded(bound, solutions, catalog)
    assert {r.solution_id for r in listed.select("solution_id").distinct().collect()} == {"b", "c"}
    assert listed.exceptAll(all_.where("solution_id <> 'a'")).count() == 0 and listed.count() == all_.where("solution_id <> 'a'").count()
