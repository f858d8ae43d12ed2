"""Whole runs: from bronze rows to written silver, quarantine and gold tables."""
