"""Raw files, stored tables and the loads between them."""
