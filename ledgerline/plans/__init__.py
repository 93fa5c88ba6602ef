"""The two report jobs."""
