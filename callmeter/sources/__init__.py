"""Where records, rules and totals come from."""
