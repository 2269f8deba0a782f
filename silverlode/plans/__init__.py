"""Layer plans: pure DataFrame functions per table, and the jobs that run them against a store."""
