"""Scratch folders for queries that write: below the shared folder the session names."""

import uuid

from ..session import shared_dir


def scratch(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/scratch-{name}-{uuid.uuid4().hex}"
