"""Batch operators over log relations."""
