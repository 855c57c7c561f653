"""What ties the library to the driver's tables: proxy tables, registered queries, oracle SQL."""
