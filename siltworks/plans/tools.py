"""The registry as tools over standard input and output (JSON-RPC, a message a line).

Two read-only tools: ``list_models`` with optional filters, and ``get_model``.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterable
from typing import Any, TextIO

from pyspark.sql import SparkSession

from ..operators import registry
from ..sources import registry as registry_files

VERSION = "2025-06-18"
_TEXT = {"type": "string"}
TOOLS = [
    {"name": "list_models", "description": "Registered model versions, newest first; filters combine as AND.", "annotations": {"readOnlyHint": True},
     "inputSchema": {"type": "object", "properties": {"status": {"enum": ["candidate", "promoted", "retired"]}, "adapter_name": _TEXT}}},
    {"name": "get_model", "description": "The full manifest of one model version.", "annotations": {"readOnlyHint": True},
     "inputSchema": {"type": "object", "properties": {"model_version": _TEXT}, "required": ["model_version"]}},
]


def list_models(spark: SparkSession, root: str, status: str | None = None, adapter_name: str | None = None) -> dict[str, Any]:
    found = registry_files.scan(spark, root)
    models = [r.asDict() for r in registry.summary(registry.newest(found, status, adapter_name)).collect()]
    return {"models": models, "invalid_keys": [r["key"] for r in registry.invalid_keys(found).collect()]}


def get_model(spark: SparkSession, root: str, model_version: str) -> dict[str, Any]:
    return registry_files.get(spark, root, model_version)


def handle(spark: SparkSession, root: str, message: dict[str, Any]) -> dict[str, Any] | None:
    """The reply to one message; None for a notification."""
    if "id" not in message:
        return None
    method, params = message.get("method"), message.get("params") or {}
    reply: dict[str, Any] = {"jsonrpc": "2.0", "id": message["id"]}
    if method == "initialize":
        return reply | {"result": {"protocolVersion": VERSION, "capabilities": {"tools": {}}, "serverInfo": {"name": "siltworks-registry", "version": "0.1.0"}}}
    if method == "tools/list":
        return reply | {"result": {"tools": TOOLS}}
    if method != "tools/call":
        return reply | {"error": {"code": -32601, "message": f"unknown method {method}"}}
    tools: dict[str, Callable[..., dict[str, Any]]] = {"list_models": list_models, "get_model": get_model}
    if params.get("name") not in tools:
        return reply | {"error": {"code": -32602, "message": f"unknown tool {params.get('name')}"}}
    try:
        result, failed = tools[params["name"]](spark, root, **(params.get("arguments") or {})), False
    except Exception as e:
        result, failed = {"error": str(e)}, True
    return reply | {"result": {"content": [{"type": "text", "text": json.dumps(result, ensure_ascii=False)}], "structuredContent": result, "isError": failed}}


def serve(spark: SparkSession, root: str, lines: Iterable[str] = sys.stdin, out: TextIO = sys.stdout) -> None:
    for line in lines:
        if not line.strip():
            continue
        try:
            reply = handle(spark, root, json.loads(line))
        except ValueError:
            reply = {"jsonrpc": "2.0", "id": None, "error": {"code": -32700, "message": "no JSON"}}
        if reply is not None:
            print(json.dumps(reply, ensure_ascii=False), file=out, flush=True)
