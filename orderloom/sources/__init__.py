"""Reading raw files into typed tables, and writing exports."""
