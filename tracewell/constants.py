"""Fixed values of the event contract. They must not be changed: stored events
and digests are only comparable while these stay equal."""

REDACTED = "[REDACTED]"
TRUNCATION_MARK = "...[TRUNCATED]"

# Key names whose whole value is redacted, compared lower-cased.
SENSITIVE_KEYS = (
    "password", "passwd", "secret", "token",
    "api_key", "apikey", "api_secret", "access_token", "refresh_token",
    "authorization", "auth", "credential", "credentials",
    "private_key", "ssh_key", "session_id", "session_token", "cookie",
    "credit_card", "card_number", "cvv", "ssn",
)

# Header names redacted whole (authorization is hashed when a key is given).
SENSITIVE_HEADERS = (
    "authorization", "cookie", "set-cookie",
    "x-api-key", "x-auth-token", "proxy-authorization",
)

HEALTH_PATHS = ("/health", "/health_check", "/ready")
HEALTH_SEGMENTS = (
    "health", "healthz", "healthcheck", "health_check", "health-check",
    "ready", "readyz", "readiness", "live", "livez", "liveness",
)

# Names and name prefixes of the span attributes that the mapping reads, as declared below.
READ_NAMES: set[str] = set()
READ_PREFIXES: set[str] = set()


def _read(*names: str) -> tuple[str, ...]:
    READ_NAMES.update(names)
    return names


def _read_below(prefix: str) -> str:
    READ_PREFIXES.add(prefix)
    return prefix


# Span attribute names, in order of preference.
MODEL_KEYS = _read("llm.model_name", "embedding.model_name", "llm.model", "gen_ai.request.model")
PROVIDER_KEYS = _read("llm.system", "gen_ai.provider.name", "gen_ai.system")
RESPONSE_MODEL_KEYS = _read("gen_ai.response.model",)
INPUT_KEYS = _read("input.value", "gen_ai.input.value", "gen_ai.request.input")
OUTPUT_KEYS = _read("output.value", "gen_ai.output.value")
ROUTE_KEYS = _read("http.route", "url.path", "http.target")
INVOCATION_KEYS = _read("llm.invocation_parameters", "embedding.invocation_parameters")
SPAN_KIND_KEYS = (*_read("openinference.span.kind"), "span.kind")
SPAN_KIND_VALUES = ("llm", "embedding")
(OPERATION_KEY,) = _read("gen_ai.operation.name")
REQUEST_PREFIX = _read_below("gen_ai.request.")
REQUEST_PARAMS = ("temperature", "top_p", "max_tokens")
(INPUT_MESSAGES,) = _read("llm.input_messages")
(OUTPUT_MESSAGES,) = _read("llm.output_messages")
(ERROR_KEY,) = _read("error.type")
_read_below(INPUT_MESSAGES + ".")
_read_below(OUTPUT_MESSAGES + ".")

(MCP_METHOD_KEY,) = _read("mcp.method.name")
SERVER_KEYS = _read("mcp.backend.name", "mcp.backend", "mcp.server.name")
SESSION_KEYS = _read("mcp.session.id", "session.id")
(CLIENT_NAME_KEY,) = _read("mcp.client.name")
(CLIENT_VERSION_KEY,) = _read("mcp.client.version")
(REQUEST_ID_KEY,) = _read("mcp.request.id")
(TRANSPORT_KEY,) = _read("mcp.transport")
(PROTOCOL_KEY,) = _read("mcp.protocol.version")
ARGUMENT_KEYS = _read(
    "mcp.tool.arguments", "mcp.request.arguments", "mcp.tool.call.arguments", "input.value",
)
ARGUMENT_PREFIX = _read_below("mcp.request.argument.")
TOOL_LIST_KEYS = _read("mcp.tools.list", "output.value")

# Event column <- span attributes, first present one.
TOKEN_KEYS = {
    "tokens_prompt": _read("llm.token_count.prompt", "gen_ai.usage.input_tokens"),
    "tokens_completion": _read("llm.token_count.completion", "gen_ai.usage.output_tokens"),
    "tokens_total": _read("llm.token_count.total", "gen_ai.usage.total_tokens"),
    "tokens_cache_hit": _read(
        "llm.token_count.prompt_details.cache_read", "llm.token_count.prompt_cache_hit",
    ),
    "tokens_cache_write": _read("llm.token_count.prompt_details.cache_creation",),
    "tokens_reasoning": _read(
        "llm.token_count.completion_details.reasoning",
        "llm.token_count.completion.reasoning",
        "llm.token_count.completion_reasoning",
    ),
}

# Operation name -> event method.
LLM_METHODS = {
    "chat": "llm_chat_completion",
    "chat_completions": "llm_chat_completion",
    "chatcompletions": "llm_chat_completion",
    "completion": "llm_completion",
    "text_completion": "llm_completion",
    "embedding": "llm_embeddings",
    "embeddings": "llm_embeddings",
    "messages": "llm_messages",
}
# Otherwise the first substring found in the name without blanks, "_" and "-".
LLM_METHOD_HINTS = (
    ("chatcompletion", "llm_chat_completion"),
    ("embedding", "llm_embeddings"),
    ("message", "llm_messages"),
    ("completion", "llm_completion"),
)
LLM_METHOD_DEFAULT = "llm_call"
# Model substring -> provider, for embedding calls without a provider.
EMBEDDING_HINTS = (
    ("text-embedding", "openai"),
    ("titan-embed", "amazon"),
    ("voyage", "voyage"),
    ("embed-", "cohere"),
)
# JSON-RPC method -> (event method, event type, handler attribute).
MCP_METHODS = {
    "tools/call": ("mcp_tool_call", "tool_call", *_read("mcp.tool.name")),
    "resources/read": ("mcp_resource_read", "resource_read", *_read("mcp.resource.uri")),
    "prompts/get": ("mcp_prompt_get", "prompt_get", *_read("mcp.prompt.name")),
}

# Lower-cased request paths that are model APIs, as one regular expression.
LLM_PATH_PATTERN = (
    r"/completions$|/embeddings$|/converse$|/converse-stream$"
    r"|/v1/messages|generatecontent|/v1/responses"
    r"|:predict|:rawpredict|:streamrawpredict"
    r"|/model/.*/invoke$|/model/.*/invoke-with-response-stream$"
    r"|/model/invoke$|/model/invoke-with-response-stream$"
)
# Prompt-shaped bodies: companions of "model" and of "prompt".
MODEL_COMPANIONS = (
    "prompt", "input", "messages", "contents", "message", "chat_history", "texts",
)
PROMPT_COMPANIONS = ("max_tokens", "max_tokens_to_sample", "temperature", "top_p")

# Limits.
MAX_REDACT_DEPTH = 20
MAX_ATTRIBUTE_DEPTH = 32
MAX_VALUE_CHARS = 8192
MAX_USER_AGENT_CHARS = 1024
MAX_USER_ID_CHARS = 256
MAX_ERROR_CHARS = 2048
MAX_LABEL_CHARS = 256
MAX_IP_CHARS = 64
MAX_EXTRA_VALUE_BYTES = 1024
MAX_EXTRA_ATTRIBUTES = 20
MAX_EXTRA_NAME_CHARS = 128
MAX_ARGUMENT_CHARS = 200
MAX_EXPORT_BYTES = 16 * 1024 * 1024
BODY_HEAD_BYTES = 24576
BODY_TAIL_BYTES = 16384
DEFAULT_EVENT_BYTES = 57344
MIN_EVENT_BYTES = 1024
MAX_EVENT_BYTES = 63488
DEFAULT_BATCH_SIZE = 50
MAX_BATCH_SIZE = 1000
