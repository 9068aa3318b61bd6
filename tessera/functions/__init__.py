"""Pure Column -> Column helpers (built-in expressions only, no UDFs)."""

from tessera.functions.chat import (canonical_line, canonical_line_bytes, content_chars,
                                    first_content, json_string, message, nest)
from tessera.functions.radix import decode, pick, rotated_pick
from tessera.functions.text import (approx_tokens, capitalise, content_hash, decode_file_name,
                                    file_name, fill, humanise, megabytes, substitute,
                                    template_parts)

__all__ = [
    "approx_tokens", "canonical_line", "canonical_line_bytes", "capitalise", "content_chars",
    "content_hash", "decode", "decode_file_name", "file_name", "fill", "first_content",
    "humanise", "json_string", "megabytes", "message", "nest", "pick", "rotated_pick",
    "substitute", "template_parts",
]
