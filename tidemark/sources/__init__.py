"""Readers and writers of event logs, panels and reports."""
