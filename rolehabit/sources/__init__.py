"""Readers: audit logs, account and role exports, the baseline store."""
