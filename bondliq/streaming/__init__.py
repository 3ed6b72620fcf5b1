"""File-triggered daily runs on Structured Streaming (see ``daily_trigger``)."""
