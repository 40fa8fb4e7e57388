"""Products composed of operators: silver and gold tables, reports, messages, the daily run."""
