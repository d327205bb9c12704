"""What to do, as tables: retries, reruns, clean-up, rules, reports."""
