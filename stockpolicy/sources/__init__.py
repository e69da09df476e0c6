"""Mapped extracts in, layers and dated snapshots out."""
