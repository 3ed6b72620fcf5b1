"""Readers: dated CSV inputs, the weights table, fixture views over test tables."""
