"""Wearable-device and questionnaire analytics as Spark plans."""

from vitalgrid.session import prepare_session

__all__ = ["prepare_session"]
