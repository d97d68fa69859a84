"""Provider-directory analytics as Spark DataFrame jobs.

Layers: archives -> Bronze (one state, source text) -> Silver (conformed, deduplicated)
-> Gold (tables, views, aggregate queries), plus snapshot comparison and lineage.
"""

from rosterlake.errors import RosterError
from rosterlake.layout import DirectoryProfile

__all__ = ["DirectoryProfile", "RosterError"]
