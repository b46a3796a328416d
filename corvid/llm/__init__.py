"""Operators for preparing training data: filtering, deduplication, scanning, mixing and
tokenising whole document tables. Nothing else in the library imports this subpackage."""
