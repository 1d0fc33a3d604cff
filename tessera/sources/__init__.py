"""Sources: line files, prepared sets, prompts, vocabulary tables."""

from .lines import (MESSAGES_TYPE, expand_file_prompts, prompts_from_list, read_chunks, read_lines, read_messages,
                    read_prompts, read_table)
from .vocab import byte_vocab, special_tokens, special_tokens_map

__all__ = ["MESSAGES_TYPE", "expand_file_prompts", "prompts_from_list", "read_chunks", "read_lines", "read_messages",
           "read_prompts", "read_table", "byte_vocab", "special_tokens", "special_tokens_map"]
