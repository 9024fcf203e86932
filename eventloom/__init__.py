"""Behavioural event analytics as plain DataFrame -> DataFrame functions."""
