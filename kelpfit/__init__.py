"""Classical machine learning as distributed DataFrame jobs."""
