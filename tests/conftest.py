import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docsearch-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def sample(spark):
    """Five business documents."""
    rows = [
        ("inv_1", "Invoice #INV-2024-001 from Acme Corp. Total amount: $1,250.00. "
                  "Services: Web development and consulting. Payment terms: Net 30 days.",
         "acme_corp", "invoice", "2024-01-05"),
        ("po_1", "Purchase Order #PO-2024-001 for office supplies. Vendor: Paper House. "
                 "Items: Paper, pens, folders.", "paper_house", "purchase_order", "2024-01-06"),
        ("inv_2", "Invoice #INV-2024-002 from Tech Solutions. Software licensing fees: "
                  "$2,500.00. Annual subscription.", "tech", "invoice", "2024-01-10"),
        ("contract_1", "Service agreement with Cloud Host. Monthly hosting fees: $199.99. "
                       "Services include server hosting and backup.", "cloud", "contract",
         "2024-01-15"),
        ("receipt_1", "Receipt from a travel agency. Flight tickets: $850.00. Destination: "
                      "New York. Client meeting.", "travel", "receipt", "2024-01-20"),
    ]
    return spark.createDataFrame(
        rows, "doc_id string, content string, entity_id string, doc_type string, day string"
    ).selectExpr("doc_id", "content", "entity_id", "doc_type",
                 "cast(day as timestamp_ntz) as date")
