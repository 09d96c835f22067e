"""Whole runs: the four steps chained, over all projects or one."""
