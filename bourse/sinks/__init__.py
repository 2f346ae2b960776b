from bourse.sinks.writers import (bronze_folder, land_bronze, land_documents, land_provider_documents, write_calendar,
                                  write_gold, write_silver)

__all__ = ["bronze_folder", "land_bronze", "land_documents", "land_provider_documents", "write_calendar", "write_gold", "write_silver"]
