"""Stateful stream forms and streaming sinks."""
