"""Business models, check list and the refresh job."""
