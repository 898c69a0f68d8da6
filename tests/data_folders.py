"""Folders of the given test tables."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
