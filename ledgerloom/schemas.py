"""Schemas of the raw logs (see FIXTURES.md) and of the stream records."""

EVENT_LOG = (
    "STRUCT<blockHash: STRING, blockNumber: STRING, transactionHash: STRING, "
    "transactionIndex: STRING, address: STRING, topics: ARRAY<STRING>, data: STRING, "
    "logIndex: STRING, removed: BOOLEAN>"
)

SIGNATURES = "ARRAY<STRUCT<V: STRING, R: STRING, S: STRING>>"

TRANSACTION = (
    "STRUCT<accessList: ARRAY<STRING>, blockHash: STRING, blockNumber: STRING, chainId: STRING, "
    "contractAddress: STRING, `from`: STRING, gas: STRING, gasPrice: STRING, gasUsed: STRING, "
    f"input: STRING, logs: ARRAY<{EVENT_LOG}>, logsBloom: STRING, maxFeePerGas: STRING, "
    "maxPriorityFeePerGas: STRING, nonce: STRING, senderTxHash: STRING, "
    f"signatures: {SIGNATURES}, status: STRING, `to`: STRING, transactionHash: STRING, "
    "transactionIndex: STRING, type: STRING, typeInt: INT, value: STRING, codeFormat: STRING, "
    f"feePayer: STRING, feePayerSignatures: {SIGNATURES}, feeRatio: STRING, "
    "humanReadable: BOOLEAN, `key`: STRING, txError: STRING, effectiveGasPrice: STRING>"
)

BLOCK_CONTENT = (
    "STRUCT<baseFeePerGas: STRING, blockscore: STRING, committee: ARRAY<STRING>, "
    "extraData: STRING, gasUsed: STRING, governanceData: STRING, hash: STRING, "
    "logsBloom: STRING, number: STRING, parentHash: STRING, proposer: STRING, "
    "receiptsRoot: STRING, reward: STRING, size: STRING, stateRoot: STRING, "
    "timestamp: STRING, timestampFoS: STRING, totalBlockScore: STRING, "
    f"transactionsRoot: STRING, voteData: STRING, transactions: ARRAY<{TRANSACTION}>>"
)

BLOCK_LOG = f"blockNumber BIGINT, result {BLOCK_CONTENT}"

# Calls nest without limit, so each top-level call stays JSON text here and is
# opened as VARIANT by the call operators.
TRACE_LOG = "blockNumber BIGINT, result ARRAY<STRING>"

# Fields that have to be present for a line to count as decodable.
REQUIRED_BLOCK_FIELDS = (
    "committee", "extraData", "gasUsed", "hash", "logsBloom", "number", "parentHash",
    "receiptsRoot", "reward", "size", "stateRoot", "timestamp", "timestampFoS",
    "totalBlockScore", "transactionsRoot", "voteData", "transactions",
)
REQUIRED_TRANSACTION_FIELDS = (
    "blockHash", "blockNumber", "from", "gas", "gasUsed", "logs", "logsBloom", "nonce",
    "senderTxHash", "signatures", "status", "transactionHash", "transactionIndex", "type",
    "typeInt",
)
REQUIRED_LOG_FIELDS = (
    "blockHash", "blockNumber", "transactionHash", "transactionIndex", "address", "topics",
    "data", "logIndex",
)

# One record of the segmented stream: a piece of a JSON line.
SEGMENT = "block_number BIGINT, segment_index INT, total_segments INT, piece STRING"
