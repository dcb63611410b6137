"""The shared folder of intermediate tables, as in the rest of the library."""

from __future__ import annotations

from millrace.sources.workspace import Workspace

__all__ = ["Workspace"]
