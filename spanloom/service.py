"""The analysis of single texts over HTTP: GET /health; POST /analyze, /analyze/batch, /analyze/plain, /evaluate.

A thin wrapper for callers that have no session; tables go through risk.analyze_texts.
"""

from __future__ import annotations

import json
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from spanloom.operators import entities, risk


class Refused(Exception):
    """A request that gets this status."""

    def __init__(self, status: int, detail: str) -> None:
        super().__init__(detail)
        self.status = status


class Service:
    """answer(method, path, body) gives a status and what to say; until ready, every analysis is refused with 503."""

    def __init__(self, policy: entities.Policy = entities.Policy(), backend: entities.Backend | None = None, ready: bool = True) -> None:
        self.policy, self.backend, self.ready = policy, backend, ready

    def _found(self, text: str, document_id: str | None = None) -> dict:
        began = time.perf_counter()
        found = entities.detect(text, self.policy, self.backend)
        said = [{"type": e.type, "start": e.start, "end": e.end, "score": round(e.score, 4), "text": text[e.start : e.end]} for e in found]
        return {"document_id": document_id, "has_pii": bool(found), "entity_count": len(found), "entities": said, "processing_time_ms": round((time.perf_counter() - began) * 1000, 2)}

    def _risk(self, text: str, document_id: str | None) -> dict:
        began = time.perf_counter()
        broken = risk.evaluate(text, entities.detect(text, self.policy, self.backend))
        severity = max((v.severity for v in broken), key=risk.SEVERITIES.index, default="none")
        said = [{"kind": v.kind, "severity": v.severity, "rule_name": v.rule, "entity_types": [e.type for e in v.entities], "span": [min(e.start for e in v.entities), max(e.end for e in v.entities)], "score": round(v.score, 4)} for v in broken]
        return {"document_id": document_id, "has_violation": bool(broken), "max_severity": severity, "violations": said, "processing_time_ms": round((time.perf_counter() - began) * 1000, 2)}

    def _batch(self, asked: dict) -> dict:
        began = time.perf_counter()
        texts = asked.get("texts")
        if not isinstance(texts, list) or not texts or not all(isinstance(text, str) for text in texts):
            raise Refused(422, "texts must be a list of texts and not empty")
        ids = asked.get("document_ids") or [None] * len(texts)
        if len(ids) != len(texts):
            raise Refused(422, "document_ids must be as many as texts")
        results = [self._found(text, one) for text, one in zip(texts, ids)]
        return {"results": results, "total_processing_time_ms": round((time.perf_counter() - began) * 1000, 2)}

    def _said(self, method: str, path: str, body: bytes) -> dict:
        if (method, path) == ("GET", "/health"):
            return {"status": "ok", "ner_model": "regex-only" if self.backend is None else type(self.backend).__name__, "ready": self.ready}
        if method != "POST" or path not in ("/analyze", "/analyze/batch", "/analyze/plain", "/evaluate"):
            raise Refused(404, "not found")
        if not self.ready:
            raise Refused(503, "not ready")
        try:
            text = body.decode()
            asked = {"text": text} if path == "/analyze/plain" else json.loads(text)
        except ValueError as wrong:
            raise Refused(422, f"unreadable: {wrong}") from wrong
        if not isinstance(asked, dict):
            raise Refused(422, "an object is asked for")
        if path == "/analyze/batch":
            return self._batch(asked)
        if not isinstance(asked.get("text"), str):
            raise Refused(422, "text is missing")
        return (self._risk if path == "/evaluate" else self._found)(asked["text"], asked.get("document_id"))

    def answer(self, method: str, path: str, body: bytes = b"") -> tuple[int, dict]:
        try:
            return 200, self._said(method, path, body)
        except Refused as refused:
            return refused.status, {"detail": str(refused)}


def server(service: Service, port: int = 8000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that is not yet running: call serve_forever."""

    class Handler(BaseHTTPRequestHandler):
        def _reply(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            status, said = service.answer(self.command, self.path, body)
            data = json.dumps(said, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _reply

        def log_message(self, *_) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
