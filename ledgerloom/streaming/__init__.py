"""Structured Streaming jobs: order status, stock balances, stock changes."""
