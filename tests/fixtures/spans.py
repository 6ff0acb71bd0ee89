"""Trace exports, built in code in the OTLP/JSON form."""

import base64
import hashlib
import json

TRACES = [hashlib.md5(name.encode()).digest() for name in ("chat", "messages", "call", "any")]


def any_value(value):
    if isinstance(value, bool):
        return {"boolValue": value}
    if isinstance(value, int):
        return {"intValue": str(value)}
    if isinstance(value, float):
        return {"doubleValue": value}
    if isinstance(value, bytes):
        return {"bytesValue": base64.b64encode(value).decode()}
    if isinstance(value, list):
        return {"arrayValue": {"values": [any_value(v) for v in value]}}
    if isinstance(value, dict):
        return {"kvlistValue": {"values": attributes(value)}}
    if value is None:
        return {}
    return {"stringValue": value}


def attributes(values):
    pairs = values.items() if isinstance(values, dict) else values
    return [{"key": k, "value": any_value(v)} for k, v in pairs]


def span(name, attrs, *, trace=TRACES[3], span_id=TRACES[3][:8], start=1762340000_000000000,
         millis=10.0, status=None, events=()):
    return {
        "traceId": base64.b64encode(trace).decode(),
        "spanId": base64.b64encode(span_id).decode(),
        "name": name,
        "startTimeUnixNano": str(start),
        "endTimeUnixNano": str(start + int(millis * 1e6)),
        "status": status or {},
        "attributes": attributes(attrs),
        "events": [{"name": "e", "attributes": attributes(e)} for e in events],
    }


def export(*spans, scope="gateway"):
    return json.dumps({"resourceSpans": [{"scopeSpans": [{"scope": {"name": scope}, "spans": list(spans)}]}]})


CHAT = span(
    "ChatCompletions",
    {
        "user.id": "skipper-9",
        "http.user_agent": "harbour-desk/3.2",
        "http.client_ip": "192.0.2.44, 172.16.3.9",
        "gen_ai.system": "tidewater",
        "gen_ai.request.model": "tidewater-small-3",
        "gen_ai.usage.input_tokens": 311,
        "gen_ai.usage.output_tokens": 57,
        "gen_ai.usage.total_tokens": 368,
        "gen_ai.request.temperature": 0.25,
        "gen_ai.request.max_tokens": 90,
        "llm.invocation_parameters": '{"stream": "no", "temperature": 1, "seed": 5}',
        "gen_ai.input.value": '{"question": "When does the ferry leave?", "secret": "k-0815"}',
        "llm.output_messages.1.message.role": "assistant",
        "llm.output_messages.1.message.content": "At noon.",
    },
    trace=TRACES[0], span_id=TRACES[0][:8], start=1762345678_500000000, millis=820.25,
)
MESSAGES = span(
    "Messages",
    {
        "openinference.span.kind": "llm",
        "gen_ai.provider.name": "lighthouse",
        "embedding.model_name": "lighthouse-xl",
        "gen_ai.response.model": "lighthouse-xl-0905",
        "llm.token_count.completion_details.reasoning": 12,
        "llm.token_count.prompt_details.cache_creation": 64,
        "llm.invocation_parameters": '{"stream": 1, "top_p": 0.9}',
        "input.value": "Name three lighthouses",
        "http.client_ip": "2001:db8:7::f00d",
    },
    trace=TRACES[1], span_id=TRACES[1][:8], start=1762349999_000000000, millis=41,
)
LLM_ERROR = span(
    "Responses",
    {"gen_ai.request.model": "tidewater-small-3", "span.kind": "LLM", "error.type": "Overloaded"},
    start=1762350100_000000000, millis=3, status={"code": "STATUS_CODE_ERROR", "message": "no berth free"},
)
TOOL_CALL = span(
    "call",
    {
        "mcp.method.name": "tools/call",
        "mcp.tool.name": "book_berth",
        "mcp.server.name": "harbour",
        "mcp.session.id": "tide-77",
        "mcp.client.name": "desk",
        "mcp.client.version": "8",
        "mcp.request.arguments": '{"boat": "Marie", "nights": 2, "cvv": "901"}',
        "http.user_agent": "desk/8",
        "http.client_ip": "192.0.2.91",
    },
    trace=TRACES[2], span_id=TRACES[2][:8], start=1762350200_250000000, millis=12.5,
)
TOOL_CALL_ROUTED = span(
    "call",
    {"mcp.method.name": "tools/call", "mcp.tool.name": "book_berth", "mcp.tool.arguments": "{}"},
    events=[{"mcp.server.name": "first"}, {"mcp.session.id": "tide-78", "mcp.server.name": "harbour"}],
)
RESOURCE_READ = span(
    "read", {"mcp.resource.uri": "chart://north/12", "mcp.method.name": "resources/read", "mcp.backend": "charts"}, millis=1)
TOOLS_LIST = span(
    "list",
    {
        "mcp.method.name": "tools/list",
        "mcp.backend": "harbour",
        "mcp.tools.list": json.dumps([
            {"name": "book_berth", "input_schema": {"required": ["boat"]}, "description": "Reserve a berth", "extra": 1},
            {"name": "", "description": "left out"},
            {"name": "tides"},
        ]),
    },
)
INITIALIZE = span("initialize", {"mcp.method.name": "initialize", "mcp.client.name": "desk"})
NOISE = span("disk flush", {"disk.name": "sda"})
