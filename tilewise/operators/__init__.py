"""Relational operators over boxes, groups and relations."""
