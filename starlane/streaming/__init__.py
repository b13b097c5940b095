"""Incremental work: file streams, parked orphans and their replay."""
