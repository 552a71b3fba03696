"""Utility-metering analytics as DataFrame operators: batch, backfill and streams."""
