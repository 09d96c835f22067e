"""Reading landed records, search results and stored tables; appending to stored tables."""
