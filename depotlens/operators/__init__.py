"""DataFrame-to-DataFrame operators. None of them starts a job."""
