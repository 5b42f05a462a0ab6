"""Paths shared by test modules. Not in ``conftest.py``: subfolders have their own, and the name would be ambiguous."""

SF_SMALL = "/root/testdata/sf0.001"
