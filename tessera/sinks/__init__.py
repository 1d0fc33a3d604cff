"""Sinks for prepared data, samples, metrics and generations."""

from .writers import (append_metrics, messages_json, write_chunks, write_generations,
                      write_messages, write_samples)

__all__ = ["append_metrics", "messages_json", "write_chunks", "write_generations",
           "write_messages", "write_samples"]
