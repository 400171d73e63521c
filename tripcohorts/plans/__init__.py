"""The end-to-end analyses and the jobs that write their results."""
