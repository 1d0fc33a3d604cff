"""Structured Streaming versions of the stateless preparation jobs."""

from .streams import (chat_messages_stream, corpus_chunks_stream, read_line_stream,
                      start_chat_stream, start_corpus_stream, start_counters_stream)

__all__ = ["chat_messages_stream", "corpus_chunks_stream", "read_line_stream",
           "start_chat_stream", "start_corpus_stream", "start_counters_stream"]
