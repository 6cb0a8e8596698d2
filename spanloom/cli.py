"""Command line: analyse a text file, classify or score texts, serve analyses, or list the metric specs.

    python -m spanloom.cli analyze FILE [--policy FILE] [--ner-model DIR] [--score-threshold X] [--format text|json] [--output FILE] [--evaluate]
    python -m spanloom.cli classify [TEXT ...] [--models DIR]
    python -m spanloom.cli generation [--input TEXT --output TEXT] [--models DIR]
    python -m spanloom.cli retrieval [--query TEXT --chunks JSON [--answer TEXT]] [--models DIR]
    python -m spanloom.cli serve [--port N] [--policy FILE] [--ner-model DIR]
    python -m spanloom.cli specs
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from spanloom.operators import entities, quality, risk, safety
from spanloom.sources.tables import read_jobs


def report(text: str, policy: entities.Policy, evaluate: bool, form: str, backend: entities.Backend | None = None) -> str:
    """The analysis of a text, for people or as JSON."""
    found, result = entities.detect(text, policy, backend), risk.analyze(text, policy, backend)
    spans = [{"type": e.type, "start": e.start, "end": e.end, "score": round(e.score, 4), "text": text[e.start : e.end]} for e in found]
    said = {"entities": spans} | ({"evaluation": result} if evaluate else {})
    if form == "json":
        return json.dumps(said, indent=2, ensure_ascii=False)
    lines = [f"{s['type']} {s['start']}-{s['end']} ({s['score']}): {s['text']}" for s in spans] or ["nothing found"]
    if evaluate:
        lines += [f"severity: {result['severity']}"] + [f"{v['severity']} {v['rule']} ({', '.join(v['entity_types'])})" for v in result["violations"]]
    return "\n".join(lines)


def _jobs(given: dict) -> list[dict]:
    """The job that the options name, or those that standard input holds: a JSON array, an object, or JSON lines."""
    return [given] if any(value is not None for value in given.values()) else read_jobs(sys.stdin.read())


def _model(folder: str, name: str):
    from spanloom.operators import models

    return models.Onnx(str(Path(folder) / name))


def _scorer(folder: str) -> quality.Scorer:
    from spanloom.operators import models

    return quality.RecipeScorer(models.entailment(_model(folder, "nli")), models.embedding(_model(folder, "embedding")), models.relevance(_model(folder, "relevance")))


def _classifier(folder: str) -> safety.TextClassifier:
    from spanloom.operators import models

    return models.ModelClassifier(_model(folder, "prompt_injection"), _model(folder, "moderation"))


def _tagger(folder: str) -> entities.Backend:
    from spanloom.operators import models

    return models.Tagger(models.Onnx(folder))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="spanloom")
    commands = parser.add_subparsers(dest="command", required=True)
    analyze = commands.add_parser("analyze")
    analyze.add_argument("file")
    analyze.add_argument("--policy", help="YAML or JSON file of a policy")
    analyze.add_argument("--ner-model", help="folder of a tagger")
    analyze.add_argument("--score-threshold", type=float)
    analyze.add_argument("--format", choices=("text", "json"), default="text")
    analyze.add_argument("--output")
    analyze.add_argument("--evaluate", action="store_true")
    classify = commands.add_parser("classify")
    classify.add_argument("text", nargs="*", help="standard input without it")
    generation = commands.add_parser("generation")
    generation.add_argument("--input")
    generation.add_argument("--output")
    retrieval = commands.add_parser("retrieval")
    retrieval.add_argument("--query")
    retrieval.add_argument("--chunks", help="JSON array of texts")
    retrieval.add_argument("--answer")
    for one in (classify, generation, retrieval):
        one.add_argument("--models", default="./models", help="folder of the models' folders")
    serve = commands.add_parser("serve")
    serve.add_argument("--port", type=int, default=8000)
    serve.add_argument("--policy")
    serve.add_argument("--ner-model")
    commands.add_parser("specs")
    return parser


def main(arguments: list[str] | None = None, scorer: quality.Scorer | None = None, classifier: safety.TextClassifier | None = None) -> int:
    """scorer, classifier: used instead of the models of --models."""
    given = _parser().parse_args(arguments)
    if given.command == "specs":
        from spanloom.plans.specs import SPECS

        print("\n".join(f"{s.lens}\t{s.metric}\t{s.applies}\t{s.unit}\t{s.window}\t{'threshold' if s.threshold else ''}\t{'' if s.per_span else 'read'}" for s in SPECS))
    elif given.command == "classify":
        text = " ".join(given.text).strip() or sys.stdin.read()
        print(json.dumps(safety.classify_text(text, classifier or _classifier(given.models)), indent=2))
    elif given.command == "generation":
        jobs = [(job.get("input") or "", job.get("output") or "") for job in _jobs({"input": given.input, "output": given.output})]
        print(json.dumps((scorer or _scorer(given.models)).generation(jobs), indent=2))
    elif given.command == "retrieval":
        chunks = None if given.chunks is None else json.loads(given.chunks)
        asked = _jobs({"query": given.query, "chunks": chunks}) if given.query is not None or chunks is not None else read_jobs(sys.stdin.read())
        jobs = [(job.get("query") or "", job.get("chunks") or [], job.get("answer", given.answer)) for job in asked]
        print(json.dumps((scorer or _scorer(given.models)).retrieval(jobs), indent=2))
    elif given.command == "serve":
        from spanloom import service

        service.server(service.Service(entities.Policy.load(given.policy), _tagger(given.ner_model) if given.ner_model else None), given.port).serve_forever()
    else:
        policy = entities.Policy.load(given.policy, given.score_threshold)
        said = report(Path(given.file).read_text(), policy, given.evaluate, given.format, _tagger(given.ner_model) if given.ner_model else None)
        if given.output:
            Path(given.output).write_text(said)
        else:
            sys.stdout.write(said + "\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())
