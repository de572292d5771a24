"""Streaming operators."""

from millrace.streaming.late import label_late
from millrace.streaming.metrics import MetricsListener
from millrace.streaming.queues import queue_status_stream
from millrace.streaming.signals import wait_notify_stream

__all__ = ["MetricsListener", "label_late", "queue_status_stream", "wait_notify_stream"]
