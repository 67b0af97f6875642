"""Reading, generating, reshaping and writing tables."""
