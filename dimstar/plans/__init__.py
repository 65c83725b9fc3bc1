"""Plans: the load, registered queries and their oracle SQL, the SQL API."""
