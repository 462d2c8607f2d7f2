"""Reading fields and file listings, and writing fields and training frames."""
