"""Fixed values of the ledger formats.

Everything in this module has to equal what the chains and the token standards
use on the wire; none of it is a design choice of this library.
"""

# Special addresses.
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
DEAD_ADDRESS = "0x000000000000000000000000000000000000dead"
THIRD_BURN_ADDRESS = "0x0000000000000000000000000000000deadc0c0a"

# A transfer to one of these is a burn; holder tables use the smaller sets below.
BURN_ADDRESSES = (ZERO_ADDRESS, DEAD_ADDRESS, THIRD_BURN_ADDRESS)
ZERO_OR_DEAD = (ZERO_ADDRESS, DEAD_ADDRESS)
ZERO_ONLY = (ZERO_ADDRESS,)

# Topic 0 of the events the operators look at.
TOPIC_TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TOPIC_APPROVAL = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
TOPIC_APPROVAL_FOR_ALL = "0x17307eab39ab6107e8899845ad3d59bd9653f200f220920489ca2b5937696c31"
TOPIC_TRANSFER_SINGLE = "0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62"
TOPIC_TRANSFER_BATCH = "0x4a39dc06d4c0dbc64b70af90fd698a233a518aa5d07e595d983b8c0526c8f7fb"
TOPIC_URI = "0x6bb7ff708619ba0610cba295a58592e0451dee2622938c8755667688daf3529b"
TOPIC_SET_TOKEN_URI = "0xaa425fdd80303549e5f891d43e81f503f03bc88d66e218ac44f385682ce6fe0b"
TOPIC_MINTER_ADDED = "0x6ae172837ea30b801fbfcdd4108aa1d5bf8ff775444fd70256b44e6bf3dfc3f6"
TOPIC_WITHDRAWAL = "0x7fcf532c15f0a6db0bd6d0e038bea71d30d808c7d98cb3bf7268a95bf5081b65"
TOPIC_DEPOSIT = "0xe1fffcc4923d04b559f4d29a8bfc6cda04eb5b0d3c460751c2402c5c5cc9109c"
TOPIC_MINT = "0x2f00e3cdd69a77be7ed215ec7b2a36784dd158f921fca79ac29deffa353fe6ee"
TOPIC_BURN = "0xcc16f5dbb4873280815c1ee09dbd06736cffcc184412cf7a71a0fdb75d397ca5"
TOPIC_BURN_PAIR = "0x49995e5dd6158cf69ad3e9777c46755a1a826a446c6416992167462dad033b2a"
TOPIC_ADDR_CHANGED = "0x52d7d861f09ab3d26239d492e8968629f95e9e318cf0b73bfddc441522a15fd2"
TOPIC_NEW_RESOLVER = "0x335721b01866dc23fbee8b6b2c7b1e14d6f05c28cd35a2c934239f94095602a0"
TOPIC_NAME_CHANGED = "0xb7d29e911041e8d9b843369e890bcb72c9388692ba48b65ac54e7214c4c348f7"
TOPIC_UPGRADED = "0xbc7cd75a20ee27fd9adebab32041f755214dbc6bffa90cc0225b39da2e5c2d3b"

# Fixed value: an old contract logs NFT transfers under this short signature.
TOPIC_LEGACY_NFT_TRANSFER = "0xdfe92792f0367a3ba3758bc05e2c4f2c18cb9d65"

MINT_BURN_TOPICS = (TOPIC_MINT, TOPIC_BURN, TOPIC_BURN_PAIR)

# Contract type codes as stored.
TYPE_ERC20 = 0
TYPE_KIP7 = 1
TYPE_KIP17 = 2
TYPE_KIP37 = 3
TYPE_ERC721 = 4
TYPE_ERC1155 = 5
TYPE_CONSENSUS_NODE = 126
TYPE_CUSTOM = 127
TYPE_UNKNOWN = -1

FUNGIBLE_TYPES = (TYPE_ERC20, TYPE_KIP7)
COLLECTION_TYPES = (TYPE_KIP17, TYPE_ERC721)
MULTI_TOKEN_TYPES = (TYPE_KIP37, TYPE_ERC1155)

# Account type and transfer type codes as stored.
ACCOUNT_EOA = 0
ACCOUNT_SCA = 1
TRANSFER_TOKEN = 0
TRANSFER_NFT = 1

# Input prefixes of contract creations.
CREATE_PREFIX = "0x60806040"
CREATE2_PREFIX = "0x6150864c"

# Transaction types that may carry a new account key.
ACCOUNT_UPDATE_TYPES = (
    "TxTypeAccountUpdate",
    "TxTypeFeeDelegatedAccountUpdate",
    "TxTypeFeeDelegatedAccountUpdateWithRatio",
)

# Unit price by block for transactions that carry none, as
# (last block of the step, price). The last step has no end.
GAS_PRICE_STEPS = {
    "mainnet": ((87091199, "25000000000"), (91324799, "750000000000"), (None, "250000000000")),
    "testnet": ((87091199, "25000000000"), (90719999, "750000000000"), (None, "250000000000")),
}

# Default chain id used when a stored transaction has a blank one.
DEFAULT_CHAIN_ID = "0x2019"

# Fixed value: names of reverse records end with this.
REVERSE_SUFFIX = ".addr.reverse"

# Blocks per block-number partition (bnp).
BLOCKS_PER_PARTITION = 100000

# 4-byte selectors that a contract of each type has to implement,
# in the order in which the types are tried.
TYPE_SELECTORS = (
    (TYPE_KIP7, ("18160ddd", "70a08231", "a9059cbb", "dd62ed3e", "095ea7b3", "23b872dd",
                 "eb795549", "423f6cef", "b88d4fde", "42842e0e")),
    (TYPE_KIP17, ("70a08231", "6352211e", "b88d4fde", "42842e0e", "23b872dd", "095ea7b3",
                  "a22cb465", "081812fc", "e985e9c5", "06fdde03", "95d89b41", "c87b56dd")),
    (TYPE_KIP37, ("f242432a", "2eb2c2d6", "00fdd58e", "4e1273f4", "a22cb465", "e985e9c5",
                  "bd85b039", "0e89341c")),
    (TYPE_ERC20, ("18160ddd", "70a08231", "a9059cbb", "23b872dd", "095ea7b3", "dd62ed3e")),
    (TYPE_ERC721, ("70a08231", "6352211e", "b88d4fde", "42842e0e", "23b872dd", "095ea7b3",
                   "a22cb465", "081812fc", "e985e9c5", "06fdde03", "95d89b41", "c87b56dd")),
    (TYPE_ERC1155, ("f242432a", "2eb2c2d6", "00fdd58e", "4e1273f4", "a22cb465", "e985e9c5",
                    "0e89341c")),
)

# A record is late this many blocks behind the newest one, once a run has lasted this many seconds.
LATE_BLOCKS = 43200
LATE_START_SECONDS = 21600.0
