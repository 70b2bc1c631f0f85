"""Writers for customer lists, archived stages and run metadata."""
