"""Decoding and scoring of message streams."""
