"""Resumable builds."""
